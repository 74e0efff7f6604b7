"""Statistics, deduplication, splits, shards, mixing, packing and lookups."""

from __future__ import annotations


from pyspark.sql import functions as F

from loquarium.functions.edit import tokens
from loquarium.operators import curation, filters, lookup, stats
from loquarium.plans.tables import table, tokens_sql, whole_references

_REF = "regexp_replace(lower(text), '[^a-z ]', '', 'g')"
_LOW = "regexp_replace(lower(text), '[^a-z ]', '', 'g')"


def _clean(df):
    return df.withColumn("t", F.regexp_replace(F.lower("text"), "[^a-z ]", ""))


def pair_intersection(spark, d):
    return table(spark, d, "documents").select("doc_id").intersect(table(spark, d, "labels").select("doc_id"))


def missing_pairs(spark, d):
    a, b = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    return a.join(b, "doc_id", "left_anti").withColumn("reason", F.lit("missing_label"))


def tsv_header_rule(spark, d):
    """Turns of a conversation as lines of a file: the last of one or two, other counts rejected."""
    c = table(spark, d, "conversations")
    per = c.groupBy("conv_id").agg(F.count("*").alias("n"), F.max_by("role", "turn").alias("role"))
    return per.select("conv_id", F.when(F.col("n") <= 2, F.col("role")).alias("role"), F.when(F.col("n") > 2, F.lit("unexpected_row_count")).alias("reason"))


def vocab_counts(spark, d):
    return stats.vocabulary(_clean(table(spark, d, "documents")), "t")


def alphabet(spark, d):
    return stats.alphabet(table(spark, d, "documents").select(F.regexp_replace("text", "[^ -~]", "").alias("t")), "t")


def oov_flag(spark, d):
    v = stats.vocabulary(_clean(table(spark, d, "documents")), "t")
    return stats.out_of_vocabulary(v, stats.vocabulary(_clean(table(spark, d, "benchmark")), "t"))


OOV_SQL = f"""with v as (select unnest({tokens_sql(_LOW)}) word from documents), b as (select distinct unnest({tokens_sql(_LOW)}) word from benchmark)
select v.word, count(*) n, b.word is null oov from v left join b on b.word = v.word group by v.word, b.word"""


def char_rate(spark, d):
    r = whole_references(spark, d).withColumn("sec", F.lit(8.0))
    return r.select("doc_id", *[c.alias(n) for n, c in stats.rates(F.col("ref"), F.col("sec")).items()])


def dataset_hours(spark, d):
    """Hours by language and over all."""
    return table(spark, d, "documents").rollup("lang").agg(F.count("*").alias("n"), (F.sum("n_chars") / 3600).alias("hours"))


def histogram(spark, d):
    return stats.histogram(table(spark, d, "documents"), "n_chars", 50)


HIST_SQL = "with r as (select min(n_chars) a, max(n_chars) b from documents) select cast(least(floor((n_chars - a) / ((b - a) / 50::double)), 49) as integer) bin, count(*) n from documents, r group by 1"


def metadata_wer_slots(spark, d):
    """Token-weighted label rates by length slot."""
    t = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return stats.metadata_rates(t, "n_chars", "n_chars", ["quality", "toxic"], [(0, 1000), (1000, 3000), (3000, 100000)])


SLOTS_SQL = """with t as (select n_chars, quality, toxic, case when n_chars >= 0 and n_chars < 1000 then '0' when n_chars >= 1000 and n_chars < 3000 then '1' when n_chars >= 3000 and n_chars < 100000 then '2' end slot from labels join documents using (doc_id))
select slot, cast(sum(n_chars) as bigint) tokens, cast(sum(n_chars * quality) as double) / sum(n_chars) quality, cast(sum(n_chars * toxic) as double) / sum(n_chars) toxic from t where slot is not null group by slot"""


def multi_label_stats(spark, d):
    return stats.multi_label_stats(table(spark, d, "labels").select(F.array("quality", "toxic").alias("l")), "l")


def group_and_overall_stats(spark, d):
    e = table(spark, d, "events").select("event_type", F.round(F.col("value") * 100).cast("long").alias("v"))
    return stats.group_and_overall(e, "event_type", "v").select("event_type", "n", "mean", F.round("std", 4).alias("std"))


GROUP_SQL = "with e as (select event_type, cast(round(value * 100) as bigint) v from events where round(value * 100) <> 0) select event_type, count(*) n, avg(v) mean, round(stddev_samp(v), 4) std from e group by rollup (event_type)"


def length_percentiles(spark, d):
    return stats.length_stats(table(spark, d, "documents"), "n_chars").select(F.col("min"), F.col("max"), "mean", "median", F.round("p75", 6).alias("p75"), F.round("p99", 6).alias("p99"))


def recommend_lengths(spark, d):
    return stats.recommend_lengths(table(spark, d, "documents"), "text").select("n", F.col("p995").cast("long").alias("p995"), "mean", F.round("std", 4).alias("std"))


def dedup_rows(spark, d):
    return curation.drop_duplicates(table(spark, d, "documents").select("doc_id", "text"), ["text"], "doc_id").select("doc_id")


def min_count_labels(spark, d):
    t = table(spark, d, "documents").select("doc_id", "source")
    return curation.min_count(t, "source", 20)


def common_suffix(spark, d):
    t = table(spark, d, "pages").select("html")
    return curation.common_suffix(t, "html")


SUFFIX_SQL = """with e as (select min(reverse(html)) a, max(reverse(html)) b from pages), n as (select a, b, unnest(range(0, least(length(a), length(b)) + 1)) i from e), m as (select a, max(i) i from n where substring(a, 1, i) = substring(b, 1, i) group by a) select reverse(substring(a, 1, i)) suffix from m"""


def imbalanced_top5(spark, d):
    return curation.most_common(table(spark, d, "documents"), "source", 5)


def drop_long(spark, d):
    c = table(spark, d, "conversations")
    a = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    b = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("completion"))
    return a.join(b, ["conv_id", "turn"]).where(F.length("prompt") + F.length("completion") <= 1000).select("conv_id", "turn")


def length_ratio_filter(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.size(tokens(F.regexp_replace("text", r"[^!-~À-ÿ]+", " "))).alias("n"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("n").alias("m"))
    return c.join(nxt, ["conv_id", "turn"]).withColumn("kept", filters.length_ratio(F.col("n"), F.col("m")))


RATIO_SQL = r"""with c as (select conv_id, turn, len(list_filter(string_split(regexp_replace(text, '[^!-~À-ÿ]+', ' ', 'g'), ' '), lambda t: t <> '')) n from conversations)
select a.conv_id, a.turn, cast(a.n as integer) n, cast(b.n as integer) m, a.n between 1 and 512 and b.n between 1 and 512 and a.n <= b.n * 1.3 and b.n <= a.n * 1.3 kept from c a join c b on a.conv_id = b.conv_id and b.turn = a.turn + 1"""


def shard_assign(spark, d):
    return curation.shards(table(spark, d, "documents").select("doc_id"), "doc_id", 7)


SHARD_SQL = """with r as (select doc_id, row_number() over (order by (doc_id * 2654435761) % 4294967296, doc_id) rn, count(*) over () n from documents)
select doc_id, cast((rn - 1) // (n // 7) as integer) shard, cast((rn - 1) % (n // 7) as integer) place from r where rn <= n // 7 * 7"""


def train_val_split(spark, d):
    return curation.split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.1)


VAL_SQL = "select doc_id, case when row_number() over (order by (doc_id * 2654435761) % 4294967296, doc_id) <= cast(floor((select count(*) from documents) * 0.1) as bigint) then 'validation' else 'train' end fold from documents"


def stratified_split(spark, d):
    return curation.stratified_split(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.1)


STRAT_SQL = "select doc_id, lang, case when row_number() over (partition by lang order by (doc_id * 2654435761) % 4294967296, doc_id) <= floor(count(*) over (partition by lang) * 0.1::double) then 'validation' else 'train' end fold from documents"


def lpt_buckets(spark, d):
    """Suppliers as files, their accounts as sizes."""
    s = table(spark, d, "supplier").select("s_suppkey", F.floor(F.abs("s_acctbal") * 100).cast("long").alias("size"))
    return curation.balanced_buckets(s, "s_suppkey", "size", 4)


def duration_buckets(spark, d):
    b = curation.duration_buckets(F.col("n_chars"), 0, 8000, 8)
    return table(spark, d, "documents").groupBy(b.alias("bucket")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("total"))


def format_size(spark, d):
    return table(spark, d, "documents").select("doc_id", curation.format_size(F.col("n_chars") * F.col("n_chars")).alias("size"))


def round_robin_mix(spark, d):
    r = curation.round_robin(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id")
    return r.select("doc_id", "lang", "rn")


def temperature_weights(spark, d):
    return curation.temperature_weights(table(spark, d, "documents"), "lang", 2.0).select("source", "n", F.round("p", 9).alias("p"))


def seq_packing(spark, d):
    t = table(spark, d, "documents").select("doc_id", "n_chars")
    return curation.fixed_windows(t, "doc_id", "n_chars", 2048)


PACK_SQL = """with p as (select doc_id, n_chars n, cast(coalesce(sum(n_chars) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) a from documents where n_chars > 0),
w as (select *, unnest(range(greatest(a - 1, 0) // 2048, (a + n - 1) // 2048 + 1)) w from p)
select doc_id, w as "window", greatest(a, w * 2048) - a as "begin", least(a + n, (w + 1) * 2048 + 1) - a as "end" from w where least(a + n, (w + 1) * 2048 + 1) > greatest(a, w * 2048)"""


def ngram_counts(spark, d):
    return lookup.ngram_counts(whole_references(spark, d), "ref", 2).select("history", "word", "n")


NGRAM_SQL = f"""with t as (select list_concat(['<s>'], {tokens_sql(_REF)}, ['</s>']) w from documents), g as (select w, unnest(range(1, len(w))) i from t) select w[i] history, w[i + 1] word, count(*) n from g group by all"""


def ngram_backoff(spark, d):
    return lookup.backoff_probabilities(lookup.ngram_counts(whole_references(spark, d), "ref", 2))


BACKOFF_SQL = f"""with t as (select list_concat(['<s>'], {tokens_sql(_REF)}, ['</s>']) w from documents), g as (select w, unnest(range(1, len(w))) i from t), c as (select w[i] history, w[i + 1] word, count(*) n from g group by all)
select history, word, (n - 1.0::double) / sum(n) over (partition by history) p, cast(count(*) over (partition by history) as double) / sum(n) over (partition by history) backoff from c"""


def ngram_index_candidates(spark, d):
    """Benchmark items most of whose trigrams occur in a text."""
    b = table(spark, d, "benchmark").select("item_id", F.regexp_replace(F.lower("text"), "[^a-z ]", "").alias("p"))
    index = lookup.phrase_index(b, "item_id", "p", 3)
    return lookup.candidates(index, b, whole_references(spark, d), "doc_id", "ref", 3, k=5, least=0.8)


CAND_SQL = f"""with b as (select item_id, {_LOW} p from benchmark), x as (select distinct item_id, substring(p, i, 3) g from (select *, unnest(range(1, length(p) - 1)) i from b)),
r as (select doc_id, {_REF} t from documents), y as (select distinct doc_id, substring(t, i, 3) g from (select *, unnest(range(1, length(t) - 1)) i from r)),
h as (select doc_id, item_id, count(*) hits from x join y using (g) group by all), z as (select item_id, count(*) total from x group by 1),
s as (select doc_id, item_id phrase, hits, hits / total::double coverage from h join z using (item_id) where hits / total::double >= 0.8),
k as (select *, row_number() over (partition by doc_id order by coverage desc, phrase) r from s) select doc_id, phrase, hits, coverage, cast(r as integer) rank from k where r <= 5"""


def knn_topk(spark, d):
    e = table(spark, d, "embeddings")
    return lookup.knn(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 5).select("query", "item", "rank")


KNN_SQL = """with s as (select q.vec_id query, i.vec_id item, list_inner_product(cast(q.embedding as double[]), cast(i.embedding as double[])) s from embeddings q, embeddings i where q.vec_id % 20 = 0 and i.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query order by s desc, item) r from s) select query, item, cast(r as integer) rank from r where r <= 5"""


def knn_dedup_same_doc(spark, d):
    e = table(spark, d, "embeddings")
    owner = e.select(F.col("vec_id").alias("chunk"), F.col("label").alias("doc"))
    return lookup.drop_same_document(knn_topk(spark, d), owner, "query", "item").select("query", "item", "rank")


def corpus_mix_union(spark, d):
    """All texts of three tables, one below another."""
    parts = [table(spark, d, t).select(F.lit(t).alias("origin"), F.col(c).alias("body")) for t, c in (("documents", "text"), ("conversations", "text"), ("benchmark", "text"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("origin").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("chars"))


def explorer_page(spark, d):
    return filters.page(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), 'lang = "en" && n_chars >= 500', "n_chars", False, 1, 10).select("n_chars")


QUERIES = {
    "pair_intersection": (pair_intersection, "select doc_id from documents intersect select doc_id from labels"),
    "missing_pairs": (missing_pairs, "select doc_id, 'missing_label' reason from documents where doc_id not in (select doc_id from labels)"),
    "tsv_header_rule": (tsv_header_rule, "select conv_id, case when count(*) <= 2 then arg_max(role, turn) end role, case when count(*) > 2 then 'unexpected_row_count' end reason from conversations group by conv_id"),
    "vocab_counts": (vocab_counts, f"select word, count(*) n from (select unnest({tokens_sql(_LOW)}) word from documents) group by word"),
    "alphabet": (alphabet, "select c as char, count(*) n from (select unnest(string_split(regexp_replace(text, '[^ -~]', '', 'g'), '')) c from documents) where c <> '' group by c"),
    "oov_flag": (oov_flag, OOV_SQL),
    "char_rate": (char_rate, f"with d as (select doc_id, {_REF} ref from documents) select doc_id, cast(len({tokens_sql('ref')}) as integer) num_words, cast(length(ref) as integer) num_chars, len({tokens_sql('ref')}) / 8.0::double word_rate, length(ref) / 8.0::double char_rate from d"),
    "dataset_hours": (dataset_hours, "select lang, count(*) n, cast(sum(n_chars) as double) / 3600 as \"hours\" from documents group by rollup (lang)"),
    "histogram": (histogram, HIST_SQL),
    "metadata_wer_slots": (metadata_wer_slots, SLOTS_SQL),
    "label_stats": (lambda s, d: stats.label_stats(table(s, d, "documents"), "lang"), "select lang as label, count(*) n, count(*) / sum(count(*)) over ()::double share from documents group by lang"),
    "multi_label_stats": (multi_label_stats, "select 0 pos, count(*) filter (quality = 0) negative, count(*) filter (quality = 1) positive from labels union all select 1, count(*) filter (toxic = 0), count(*) filter (toxic = 1) from labels"),
    "group_and_overall_stats": (group_and_overall_stats, GROUP_SQL),
    "length_percentiles": (length_percentiles, "select min(n_chars) as \"min\", max(n_chars) as \"max\", avg(n_chars) mean, quantile_cont(n_chars, 0.5) median, round(quantile_cont(n_chars, 0.75), 6) p75, round(quantile_cont(n_chars, 0.99), 6) p99 from documents"),
    "recommend_lengths": (recommend_lengths, "select count(*) n, cast(quantile_disc(length(text), 0.995) as bigint) p995, avg(length(text)) mean, round(stddev_pop(length(text)), 4) std from documents"),
    "freq_weights": (lambda s, d: stats.frequency_weights(table(s, d, "documents"), "lang"), "select lang as label, sum(count(*)) over ()::double / (count(*) over () * count(*)) weight from documents group by lang"),
    "speaker_map": (lambda s, d: stats.speaker_map(table(s, d, "documents"), "source"), "select source as speaker, cast(row_number() over (order by source) - 1 as integer) idx from (select distinct source from documents)"),
    "dedup_rows": (dedup_rows, "select min(doc_id) doc_id from documents group by text"),
    "min_count_labels": (min_count_labels, "select doc_id, source from documents where source in (select source from documents group by source having count(*) >= 20)"),
    "common_suffix": (common_suffix, SUFFIX_SQL),
    "imbalanced_top5": (imbalanced_top5, "select source as value, count(*) n, count(*) / (select count(*) from documents)::double share from documents group by source order by n desc, source limit 5"),
    "drop_long": (drop_long, "select a.conv_id, a.turn from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1 where a.role = 'user' and b.role = 'assistant' and length(a.text) + length(b.text) <= 1000"),
    "length_ratio_filter": (length_ratio_filter, RATIO_SQL),
    "shard_assign": (shard_assign, SHARD_SQL),
    "train_val_split": (train_val_split, VAL_SQL),
    "stratified_split": (stratified_split, STRAT_SQL),
    "lpt_buckets": (lpt_buckets, None),
    "duration_buckets": (duration_buckets, "select case when n_chars between 0 and 8000 then cast(least(floor(n_chars / 1000.0), 7) as integer) end bucket, count(*) n, cast(sum(n_chars) as bigint) total from documents group by 1"),
    "format_size": (format_size, "with s as (select doc_id, n_chars * n_chars n from documents) select doc_id, case when n < 1024 then printf('%.1f B', n::double) when n < 1048576 then printf('%.1f KB', n / 1024::double) when n < 1073741824 then printf('%.1f MB', n / 1048576::double) else printf('%.1f GB', n / 1073741824::double) end size from s"),
    "round_robin_mix": (round_robin_mix, "select doc_id, lang, cast(row_number() over (partition by lang order by doc_id) as integer) rn from documents"),
    "temperature_weights": (temperature_weights, "select lang as source, count(*) n, round(sqrt(count(*)) / sum(sqrt(count(*))) over (), 9) p from documents group by lang"),
    "seq_packing": (seq_packing, PACK_SQL),
    "ngram_counts": (ngram_counts, NGRAM_SQL),
    "ngram_backoff": (ngram_backoff, BACKOFF_SQL),
    "ngram_index_candidates": (ngram_index_candidates, CAND_SQL),
    "knn_topk": (knn_topk, KNN_SQL),
    "knn_dedup_same_doc": (knn_dedup_same_doc, f"with k as ({KNN_SQL}) select query, item, rank from k join embeddings a on a.vec_id = query join embeddings b on b.vec_id = item where a.label <> b.label"),
    "corpus_mix_union": (corpus_mix_union, "select 'documents' origin, count(*) n, cast(sum(length(text)) as bigint) chars from documents union all select 'conversations', count(*), cast(sum(length(text)) as bigint) from conversations union all select 'benchmark', count(*), cast(sum(length(text)) as bigint) from benchmark"),
    "explorer_page": (explorer_page, "select n_chars from documents where lang = 'en' and n_chars >= 500 order by n_chars desc limit 10 offset 10"),
}
