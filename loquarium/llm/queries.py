"""The thin ``opN_`` queries over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquarium.llm.common import table
from loquarium.llm.decontaminate import decontaminate
from loquarium.llm.jaccard_join import jaccard_join
from loquarium.llm.language_id import held_out, identify, teaching, train
from loquarium.llm.line_dedup import line_dedup
from loquarium.llm.packing import best_fit_packing
from loquarium.llm.sentence_spans import substring_dedup
from loquarium.llm.token_counts import token_counts
from loquarium.llm.token_store import token_store
from loquarium.llm.vector_join import vector_join
from loquarium.llm.warc import warc_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_items") >= 2).alias("contaminated")
    )


OP1_SQL = r"""
with d as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from documents),
b as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where text is not null),
bw as (select item_id, least(8, len(w)) n, unnest(range(1, greatest(len(w) - 7, 1) + 1)) i, w from b where len(w) > 0),
bk as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') k from bw),
ns as (select distinct n from bk),
dw as (select doc_id, n, unnest(range(1, len(w) - n + 2)) i, w from d, ns where len(w) >= n),
dk as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') k from dw),
h as (select doc_id, dk.n, i, item_id from dk join bk on dk.k = bk.k and dk.n = bk.n),
p as (select doc_id, count(distinct p) c from (select doc_id, unnest(range(i, i + n)) p from (select distinct doc_id, n, i from h)) group by doc_id),
t as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items from (select distinct doc_id, cast(item_id as varchar) item from h) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(c, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(items, '')) items_sha256, coalesce(n_items, 0) >= 2 contaminated
from d left join p on d.doc_id = p.doc_id left join t on d.doc_id = t.doc_id
"""


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(spark, table(spark, sf_dir, "pages"))


OP2_SQL = """
with p as (select page_id, encode(coalesce(html, '')) b from pages),
d as (select page_id, octet_length(b) n, sha256(b) h from p),
f as (select h, min(page_id) first from d where n >= 100 group by h)
select page_id, cast(n as bigint) payload_bytes, d.h payload_digest, case when first is null or first = page_id then 'response' else 'revisit' end record_type,
case when first <> page_id then first end refers_to from d left join f on d.h = f.h
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(teaching(docs))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), drops_space=False, end_id=50256)


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(spark, table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), drops_space=False, end_id=2)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), drops_space=True, end_id=1, capacity=4096)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = jaccard_join(table(spark, sf_dir, "documents"), percent=80, n=5)
    return members.select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents where text is not null),
i as (select doc_id, w, least(5, len(w)) n, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i from w where len(w) > 0),
s as (select distinct doc_id, hash(array_to_string(w[i:i + n - 1], ' ')) g from i),
c as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id x, b.doc_id y, count(*) k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
e as (select x, y from p join c cx on cx.doc_id = x join c cy on cy.doc_id = y where 100 * k >= 80 * (cx.n + cy.n - k)),
u as (select x, y from e union all select y, x from e),
r as (select distinct x doc_id, x root from u union select u.y, r.root from r join u on u.x = r.doc_id),
m as (select doc_id, min(root) root from r group by doc_id)
select d.doc_id, coalesce(c.n, 0) n_shingles, coalesce(m.root, d.doc_id) component_id from documents d left join c on c.doc_id = d.doc_id left join m on m.doc_id = d.doc_id
"""


def op10_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join(table(spark, sf_dir, "embeddings"), threshold=0.9)


OP10_SQL = """
with recursive v as (select vec_id, cast(embedding as double[]) e from embeddings where embedding is not null),
n as (select vec_id, e, sqrt(list_inner_product(e, e)) l from v where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0),
ok as (select * from n where l > 0),
u as (select a.vec_id x, b.vec_id y from ok a join ok b on a.vec_id <> b.vec_id where list_inner_product(a.e, b.e) / (a.l * b.l) >= 0.9),
r as (select distinct x vec_id, x root from u union select u.y, r.root from r join u on u.x = r.vec_id),
m as (select vec_id, min(root) root from r group by vec_id),
k as (select x, count(*) k from u group by x)
select d.vec_id, coalesce(k.k, 0) n_links, coalesce(m.root, d.vec_id) component_id, coalesce(m.root, d.vec_id) = d.vec_id kept from embeddings d left join m on m.vec_id = d.vec_id left join k on k.x = d.vec_id
"""


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_warc": op2_warc,
        "op3_language_id": op3_language_id,
        "op4_token_counts": op4_token_counts,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_token_store": op7_token_store,
        "op8_line_dedup": op8_line_dedup,
        "op9_packing": op9_packing,
        "op10_vector_join": op10_vector_join,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1_SQL, "op2_warc": OP2_SQL, "op6_jaccard_join": OP6_SQL, "op10_vector_join": OP10_SQL}
