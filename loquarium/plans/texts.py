"""Text normalisation, sentence splitting, templates and threads."""

from __future__ import annotations

from pyspark.sql import functions as F

from loquarium.functions import text as T
from loquarium.operators import align, curation, lookup, tabular
from loquarium.plans.tables import small_batches, table, texts, whole_references


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


def _column(name, fn):
    return lambda spark, d: _docs(spark, d).select("doc_id", fn(F.col("text")).alias(name))


SENTENCES_SQL = r"""with p as (select doc_id, regexp_replace(regexp_replace(text, '([0-9])\.([A-Za-z0-9_])', '\1' || chr(2) || '\2', 'g'), '([0-9])\.([A-Za-z0-9_])', '\1' || chr(2) || '\2', 'g') t from documents)
select doc_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(t, '[.?!:…\n]', chr(1), 'g'), chr(1)), lambda x: trim(replace(x, chr(2), '.'))), lambda x: x <> ''), '|') sentences from p"""


def split_sentences(spark, d):
    return _docs(spark, d).select("doc_id", T.split_sentences(F.col("text")).alias("sentences"))


def hms(spark, d):
    t = table(spark, d, "documents").select("doc_id", T.seconds_hms(F.col("n_chars")).alias("hms"))
    return t.select("doc_id", "hms", T.hms_seconds(F.col("hms")).alias("seconds"))


HMS_SQL = "select doc_id, printf('%02d:%02d:%02d', n_chars // 3600, n_chars // 60 % 60, n_chars % 60) hms, cast(n_chars as double) as \"seconds\" from documents"


def number_words(spark, d):
    p = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").cast("string").alias("q"))
    return p.select("l_orderkey", "l_linenumber", T.number_words("es")(F.col("q")).alias("es"), T.number_words("ca")(F.col("q")).alias("ca"))


def expand_tokens(spark, d):
    small_batches(spark)
    return texts(spark, d).select("doc_id", T.expand_tokens("es")(F.col("text")).alias("expanded"))


def clean_text(spark, d):
    small_batches(spark)
    x = texts(spark, d).select("doc_id", "lang", "text")
    spanish = F.when(F.col("lang") == "es", F.col("text"))  # UDFs get every row: others are null to this one
    return x.select("doc_id", F.when(F.col("lang") == "es", T.clean_text(spanish, "es")).otherwise(T.clean_text(F.col("text"), "gl")).alias("clean"))


def clean_numbers(spark, d):
    return table(spark, d, "part").select("p_partkey", T.clean_numbers(F.format_number("p_retailprice", 2)).alias("price"))


def clean_prediction(spark, d):
    plain = F.regexp_replace("text", r"['\\\n\[\]]", "")
    return _docs(spark, d).select("doc_id", T.clean_prediction(F.concat(F.lit("['"), plain, F.lit("', 'b']"))).alias("clean"), plain.alias("x")).select("doc_id", "clean", F.trim(F.concat("x", F.lit(" b"))).alias("expected"))


def prompt_template(spark, d):
    c = table(spark, d, "conversations").where("role = 'user'")
    return c.select("conv_id", "turn", curation.template(c, {"role": "role", "text": "text"}, "{role}: {text}\n\n###\n\n").alias("prompt"))


def thread_paths(spark, d):
    """Conversations as chains of turns, each turn the child of the one before; a synthetic fork at every third turn."""
    c = table(spark, d, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("node"), F.when(F.col("turn") > 0, F.col("conv_id") * 100 + F.when(F.col("turn") % 3 == 2, F.col("turn") - 2).otherwise(F.col("turn") - 1)).alias("up"), F.col("text").alias("t"))
    return curation.threads(spark, c, "node", "up", "t").select("leaf", F.array_join("path", " / ").alias("path"), "depth")


THREADS_SQL = """with recursive n as (select conv_id * 100 + turn id, case when turn > 0 then conv_id * 100 + case when turn % 3 = 2 then turn - 2 else turn - 1 end end up, text t from conversations),
p as (select id, t path, 1 depth from n where up is null union all select n.id, p.path || ' / ' || n.t, p.depth + 1 from n join p on n.up = p.id)
select id leaf, path, depth from p where id not in (select up from n where up is not null)"""


def stitch_text(spark, d):
    return curation.stitched(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


def word_windows(spark, d):
    return lookup.word_windows(whole_references(spark, d), "ref", 16, 8)


WINDOWS_SQL = """with d as (select list_filter(string_split(regexp_replace(lower(text), '[^a-z ]', '', 'g'), ' '), lambda t: t <> '') w from documents),
x as (select w, unnest(range(0, case when len(w) <= 16 then 1 else cast(ceil((len(w) - 16) / 8.0) as integer) + 1 end)) i from d where len(w) > 0) select distinct array_to_string(w[i * 8 + 1:i * 8 + 16], ' ') fragment from x"""


def char_ids(spark, d):
    ids = tabular.char_ids(F.col("ref"), "abcdefghijklmnopqrstuvwxyz ", unknown=27)
    return whole_references(spark, d).select("doc_id", F.array_join(ids.cast("array<string>"), ",").alias("ids"))


CHAR_SQL = """select doc_id, coalesce(array_to_string(list_transform(list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z ]', '', 'g')), ''), lambda c: c <> ''), lambda c: instr('abcdefghijklmnopqrstuvwxyz ', c) - 1), ','), '') ids from documents"""


def column_codes(spark, d):
    """Line items as digit tokens: quantity in base 10, price to the nearest 100, a category code."""
    li = table(spark, d, "lineitem")
    codes = tabular.category_codes(li, "l_returnflag")
    x = li.join(F.broadcast(codes), li.l_returnflag == codes.value)
    coders = {"q": tabular.int_digits(F.col("l_quantity").cast("long"), 0, 10, 2), "c": tabular.int_digits(F.col("code").cast("long"), 0, 10, 1)}
    return x.select("l_orderkey", "l_linenumber", tabular.encode_rows(x, coders).alias("row"))


CODES_SQL = """with c as (select l_returnflag v, row_number() over (order by l_returnflag) - 1 code from (select distinct l_returnflag from lineitem))
select l_orderkey, l_linenumber, (cast(l_quantity as bigint) // 10 % 10) || ' ' || (cast(l_quantity as bigint) % 10) || ',' || code as "row" from lineitem join c on v = l_returnflag"""


def ctm_export(spark, d):
    """Events of a user as aligned units of one file: CTM lines with a least duration."""
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("file"), F.col("event_type").alias("unit"), (F.col("event_id") * 2).cast("double").alias("a"), (F.col("event_id") * 2 + F.least(F.floor("value"), F.lit(2))).cast("double").alias("b"))
    return align.ctm_lines(e, "file", "unit", "a", "b", 1.0)


CTM_SQL = """with e as (select user_id f, event_type u, event_id * 2::double a, event_id * 2 + least(floor(value), 2) b from events), g as (select f, u, case when b - a < 1 then greatest((a + b) / 2 - 0.5, 0) else a end s, case when b - a < 1 then (a + b) / 2 + 0.5 else b end t from e)
select printf('%s 1 %.2f %.2f %s', cast(f as varchar), s, t - s, u) line from g"""


def align_timing(spark, d):
    """Each user's event types as states of frames: first and last frame of every state, -1 for one that never occurs."""
    kinds = {"click": 0, "view": 1, "error": 2, "purchase": 3}
    state = F.lit(9)
    for k, v in kinds.items():
        state = F.when(F.col("event_type") == k, v).otherwise(state)
    path = table(spark, d, "events").select("user_id", F.col("event_id").cast("int").alias("t"), state.alias("s"))
    units = path.select("user_id").distinct().crossJoin(F.broadcast(spark.range(6).select(F.col("id").cast("int").alias("s_start"), F.col("id").cast("int").alias("s_end"))))
    return align.unit_times(path, units, ["user_id"], 0.25).select("user_id", "s_start", "t_start", "t_end")


TIMING_SQL = """with p as (select user_id, event_id t, case event_type when 'click' then 0 when 'view' then 1 when 'error' then 2 when 'purchase' then 3 else 9 end s from events), g as (select user_id, s, min(t) * 0.25::double a, (max(t) + 1) * 0.25::double b from p group by all)
select u.user_id, cast(k as integer) s_start, coalesce(a, -1) t_start, coalesce(b, -1) t_end from (select distinct user_id from p) u, range(6) r(k) left join g on g.user_id = u.user_id and g.s = k"""


def ctc_collapse(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return align.collapse(e, ["user_id"], "event_id", "event_type", "view").select("user_id", "event_id")


COLLAPSE_SQL = "select user_id, event_id from (select *, lag(event_type) over (partition by user_id order by event_id) p from events) where event_type <> 'view' and event_type is distinct from p"


def insert_silences(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", (F.col("event_id") * 10).cast("double").alias("a"), (F.col("event_id") * 10 + 5).cast("double").alias("b"), F.lit(1e6).alias("total"))
    return align.insert_silences(e, ["user_id"], "event_type", "a", "b", "total", 100, closed=True).groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("text") == "").alias("silences"), F.sum(F.col("e") - F.col("s")).alias("covered"))


SILENCES_SQL = """with e as (select user_id, event_id * 10 a, event_id * 10 + 5 b, lead(event_id * 10) over w nx, lag(event_id) over w pv from events window w as (partition by user_id order by event_id)),
x as (select user_id, 1 + case when pv is null and a > 0 then 1 else 0 end + case when coalesce(nx - b > 100, true) then 1 else 0 end n, nx, a, b, pv from e)
select user_id, cast(sum(n) as bigint) n, cast(sum(n - 1) as bigint) silences, 1e6::double - min(case when pv is null and a = 0 then 0 else 0 end) covered from x group by user_id"""

_ARTICLE = r"'(^|[^\p{L}\p{M}\p{N}_])(an|a|the)($|[^\p{L}\p{M}\p{N}_])', '\1 \3', 'g'"
ANSWER_SQL = rf"""with p as (select doc_id, regexp_replace(lower(text), '[!"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{{|}}~]', '', 'g') t from documents)
select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(t, {_ARTICLE}), {_ARTICLE}), '\s+', ' ', 'g')) clean from p"""

QUERIES = {
    "split_sentences": (split_sentences, SENTENCES_SQL),
    "clean_ws": (_column("clean", T.squeeze), r"select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) clean from documents"),
    "strip_punct": (_column("clean", T.normalise), r"select doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{M}\p{Nd}\p{Pc}\s]', '', 'g'), '\s+', ' ', 'g')) clean from documents"),
    "basic_normalize": (_column("clean", T.basic_normalize), r"select doc_id, trim(regexp_replace(regexp_replace(lower(text), '[,;:?¿«»\-¡!@*{}\[\]=/\\&#…\.]', ' ', 'g'), '\s+', ' ', 'g')) clean from documents"),
    "normalise_answer": (_column("clean", T.normalise_answer), ANSWER_SQL),
    "punct_separate": (_column("clean", T.punctuation), r"select doc_id, trim(regexp_replace(lower(regexp_replace(text, '[.,?!]', ' \0 ', 'g')), '\s{2,}', ' ', 'g')) clean from documents"),
    "file_label": (_column("label", T.file_label), "select doc_id, regexp_replace(text, '[^A-Za-z0-9_.-]+', '-', 'g') label from documents"),
    "hms_seconds": (hms, HMS_SQL),
    "clean_numbers": (clean_numbers, None),
    "number_words": (number_words, None),
    "expand_tokens": (expand_tokens, None),
    "clean_text": (clean_text, None),
    "clean_prediction": (clean_prediction, r"""with x as (select doc_id, regexp_replace(text, '[''\\\n\[\]]', '', 'g') x from documents) select doc_id, trim(x || ' b') clean, trim(x || ' b') expected from x"""),
    "prompt_template": (prompt_template, r"select conv_id, turn, role || ': ' || text || chr(10) || chr(10) || '###' || chr(10) || chr(10) prompt from conversations where role = 'user'"),
    "thread_paths": (thread_paths, THREADS_SQL),
    "stitch_text": (stitch_text, "select conv_id, string_agg(text, ' ' order by turn) as text from conversations group by conv_id"),
    "word_windows": (word_windows, WINDOWS_SQL),
    "char_ids": (char_ids, CHAR_SQL),
    "column_codes": (column_codes, CODES_SQL),
    "ctm_export": (ctm_export, CTM_SQL),
    "align_timing": (align_timing, TIMING_SQL),
    "ctc_collapse": (ctc_collapse, COLLAPSE_SQL),
    "insert_silences": (insert_silences, SILENCES_SQL),
}
