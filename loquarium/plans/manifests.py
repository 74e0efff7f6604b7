"""Queries of manifests, speakers, scores and records over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loquarium.operators import records, scores, speakers
from loquarium.plans.tables import SPAN_SQL, spans, table
from loquarium.sources import manifests


def preferred_transcript(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("input_id"))
    path = lambda every, name: c.where(f"input_id % {every} = 0").select("input_id", F.concat("input_id", F.lit(name)).alias("path"))
    found, rejects = manifests.preferred_transcript(c, path(3, "_norm_mark.tsv"), path(2, "_norm.tsv"))
    return found.unionByName(rejects, allowMissingColumns=True)


PREFERRED_SQL = """select c_custkey input_id, case when c_custkey % 3 = 0 then c_custkey || '_norm_mark.tsv' when c_custkey % 2 = 0 then c_custkey || '_norm.tsv' end path,
case when c_custkey % 3 <> 0 and c_custkey % 2 <> 0 then 'missing_transcript' end reason from customer"""


def full_paths(spark, d):
    """Orders as audio files: absolute, found as they are, found under the folder, not found."""
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.when(F.col("o_orderkey") % 4 == 0, "/").otherwise(""), F.lit("w"), "o_orderkey").alias("path"))
    listing = o.where("o_orderkey % 4 = 1").select("path").unionAll(o.where("o_orderkey % 4 = 2").select(F.concat(F.lit("data/"), "path").alias("path")))
    return manifests.resolve_paths(o, "path", [F.lit("data")], listing)


FULL_PATHS_SQL = """select o_orderkey, case when o_orderkey % 4 = 0 then '/' else '' end || 'w' || o_orderkey path,
case o_orderkey % 4 when 0 then '/w' when 2 then 'data/w' else 'w' end || o_orderkey resolved from orders"""


def manifest_create(spark, d):
    """Customers as files; the lines of a file are its orders, its speakers their priorities."""
    audio = table(spark, d, "customer").select(F.col("c_custkey").alias("uniq_id"), F.concat(F.lit("a"), "c_custkey").alias("path"))
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "uniq_id")
    texts = o.select("uniq_id", F.col("o_orderkey").alias("line"), F.col("o_orderstatus").alias("text"))
    rttm = o.select("uniq_id", F.lit("r").alias("path"), F.concat(F.lit("0 1 "), F.substring("o_orderpriority", 1, 1)).alias("label"))
    return manifests.create_manifest(audio, texts, rttm, audio.where("uniq_id % 2 = 0"))


MANIFEST_SQL = """with o as (select o_custkey, arg_min(o_orderstatus, o_orderkey) t, count(distinct left(o_orderpriority, 1)) n from orders group by 1)
select c_custkey uniq_id, 'a' || c_custkey audio_filepath, coalesce(t, '-') as text, n num_speakers, case when n is not null then 'r' end rttm_filepath, case when c_custkey % 2 = 0 then 'a' || c_custkey end ctm_filepath
from customer left join o on o_custkey = c_custkey"""


def shard_members(spark, d):
    """Order lines as segments of orders: members that have one of a quantity, once for each."""
    members = table(spark, d, "orders").select(F.col("o_orderkey").alias("file_id"), F.col("o_orderpriority").alias("member"))
    li = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("file_id"), F.col("l_linenumber").alias("segment"))
    return manifests.member_segments(manifests.members_in(members, li), li)


def bucket_batches(spark, d):
    li = table(spark, d, "lineitem").select(F.expr("l_suppkey % 7").alias("bucket"), "l_orderkey", "l_linenumber")
    return manifests.batches(li, ["bucket"], ["l_orderkey", "l_linenumber"], 16).groupBy("bucket", "batch").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first"))


BATCH_SQL = """with b as (select l_suppkey % 7 bucket, l_orderkey, (row_number() over (partition by l_suppkey % 7 order by l_orderkey, l_linenumber) - 1) // 16 batch from lineitem)
select bucket, batch, count(*) n, min(l_orderkey) "first" from b group by all"""


def extra_model(spark, d):
    r = table(spark, d, "supplier").select(F.col("s_suppkey").alias("segment"), F.when(F.col("s_nationkey") % 2 == 0, "gl").otherwise("ca").alias("lang"), F.when(F.col("s_suppkey") % 3 == 0, "extra").otherwise("base").alias("model"))
    return manifests.with_extra_model(r, "gl", "extra")


EXTRA_SQL = """with r as (select s_suppkey segment, case when s_nationkey % 2 = 0 then 'gl' else 'ca' end lang, case when s_suppkey % 3 = 0 then 'extra' else 'base' end model from supplier)
select * from r where lang <> 'gl' or model <> 'extra' union all select distinct segment, lang, 'extra' from r where lang = 'gl'"""


def first_segments(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return manifests.first_segments(li, ["l_orderkey"], ["l_linenumber", "l_partkey"], 2)


def source_groups(spark, d):
    s = spans(spark, d).select(F.col("user_id").alias("source"), F.col("s").alias("start"), F.col("e").alias("end"))
    return manifests.sources_of(s)


def rttm_lines(spark, d):
    s = spans(spark, d)
    label = manifests.rttm_label((F.col("s") - 1704067200) / 8, (F.col("e") - F.col("s")) / 8, F.col("event_type"))
    return s.select("event_id", manifests.label_rttm(label, F.col("user_id")).alias("line"))


RTTM_SQL = f"""with {SPAN_SQL} select event_id, printf('SPEAKER %s 1   %.3f   %.3f <NA> <NA> %s <NA> <NA>', cast(user_id as varchar), round((s - 1704067200) / 8.0::double, 3), round((e - 1704067200) / 8.0::double, 3) - round((s - 1704067200) / 8.0::double, 3), event_type) line from iv"""


def word_speakers(spark, d):
    """Errors as words, other events as turns whose speaker is their type."""
    s = spans(spark, d)
    words = s.where("event_type = 'error'").select("user_id", "event_id", F.col("s").alias("at"))
    turns = s.where("event_type <> 'error'").groupBy("user_id", "e").agg(F.min("event_type").alias("speaker"))
    return speakers.assign_words(words, turns, ["user_id"], "at", "event_id")


WORD_SPEAKERS_SQL = f"""with {SPAN_SQL}, w as (select user_id, event_id, s p from iv where event_type = 'error'),
t as (select user_id, e, min(event_type) sp from iv where event_type <> 'error' group by all),
n as (select w.event_id, arg_min(t.sp, t.e) sp from w join t on t.user_id = w.user_id and t.e >= w.p group by 1),
l as (select user_id, arg_max(sp, e) sp from t group by 1)
select w.user_id, w.event_id, w.p "at", coalesce(n.sp, l.sp) speaker from w left join n on n.event_id = w.event_id left join l on l.user_id = w.user_id"""


def vad_detection_error(spark, d):
    """Clicks and views as speech, views and purchases as what was detected."""
    s = spans(spark, d).where("e > s")
    return speakers.detection_errors(s.where("event_type in ('click', 'view')"), s.where("event_type in ('view', 'purchase')"), ["user_id"])


VAD_ERROR_SQL = f"""with {SPAN_SQL}, x as (select user_id, s, e, event_type in ('click', 'view') r, event_type in ('view', 'purchase') h from iv where e > s and event_type in ('click', 'view', 'purchase')),
d as (select user_id, s t, case when r then 1 else 0 end r, case when h then 1 else 0 end h from x union all select user_id, e, case when r then -1 else 0 end, case when h then -1 else 0 end from x),
g as (select user_id, t, sum(r) r, sum(h) h from d group by all),
p as (select user_id, lead(t) over w - t d, sum(r) over w > 0 r, sum(h) over w > 0 h from g window w as (partition by user_id order by t)),
k as (select user_id, cast(coalesce(sum(d) filter (h and not r), 0) as double) fa, cast(coalesce(sum(d) filter (r and not h), 0) as double) m, cast(coalesce(sum(d) filter (r), 0) as double) sp from p where d is not null group by 1)
select user_id, fa false_alarm, m missed, sp speech, case when sp > 0 then (fa + m) / sp end error from k"""


def remove_segments(spark, d):
    s = spans(spark, d).select("user_id", "s", "e")
    return speakers.without_intervals(s, s.where("s % 3 = 0"), ["user_id", "s", "e"])


def contiguous_stamps(spark, d):
    s = spans(spark, d).where("event_type = 'click' and e > s").select("user_id", "event_id", F.col("s").cast("double").alias("s"), F.col("e").cast("double").alias("e"))
    return speakers.split_overlaps(s.dropDuplicates(["user_id", "s", "e"]).select("user_id", "s", "e"), ["user_id"])


STAMPS_SQL = f"""with {SPAN_SQL}, x as (select distinct user_id, s, e from iv where event_type = 'click' and e > s),
y as (select user_id, s, e, lag(e) over w p, lead(s) over w n from x window w as (partition by user_id order by s, e))
select user_id, cast(case when p > s then (p + s) / 2.0 else s end as double) s, cast(case when n < e then (n + e) / 2.0 else e end as double) e from y"""


def manifest_eval(spark, d):
    """Orders as reference; every third has a prediction."""
    o = table(spark, d, "orders")
    return speakers.with_predictions(o.select("o_orderkey"), o.where("o_orderkey % 3 = 0").select("o_orderkey", F.col("o_orderpriority").alias("pred_text")), "o_orderkey", "pred_text")


def result_table(spark, d):
    der = table(spark, d, "nation").select(F.when(F.col("n_nationkey") == 0, "total").otherwise(F.col("n_nationkey").cast("string")).alias("uniq_id"), (F.col("n_nationkey") * 2).alias("der"))
    wer = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("uniq_id")).agg(F.count("*").alias("wer")).where("wer % 2 = 0")
    return speakers.result_table(der, wer)


RESULT_SQL = """with w as (select cast(s_nationkey as varchar) u, count(*) wer from supplier group by 1 having count(*) % 2 = 0)
select cast(n_nationkey as varchar) uniq_id, cast(n_nationkey * 2 as varchar) der, coalesce(cast(wer as varchar), '-') wer from nation left join w on u = cast(n_nationkey as varchar) where n_nationkey <> 0"""


def _scored(spark, d):
    return table(spark, d, "events").select(((F.round(F.col("value") * 100) % 1000) / 1000).alias("p"), (F.col("event_type") == "click").cast("int").alias("y"))


SCORED_SQL = "c as (select (round(value * 100) % 1000) / 1000 p, case when event_type = 'click' then 1 else 0 end y from events)"
AP_SQL = """g as (select {p} p, sum({y}) k, count(*) n from c group by 1), r as (select k, sum(k) over w a, sum(n) over w b from g window w as (order by p desc rows unbounded preceding))
select round(cast(sum(a / b::double * k) as double) / sum(k), 9) auc from r"""


def auc_pr(spark, d):
    return scores.auc_pr(_scored(spark, d), "p", "y").select(F.round("auc", 9).alias("auc"))


def auc_nt(spark, d):
    return scores.auc_nt(_scored(spark, d), "p", "y").select(F.round("auc", 9).alias("auc"))


def auc_yc(spark, d):
    return scores.auc_yc(_scored(spark, d), "p", "y").select(*[F.round(c, 9).alias(c) for c in ("auc", "std", "most")])


YC_SQL = f"""with {SCORED_SQL}, t as (select i / 100.0::double t from range(101) r(i)), n as (select sum(y) k, sum(1 - y) m from c),
y as (select abs((select count(*) from c where y = 0 and p < t) / m::double - (select count(*) from c where y = 1 and p < t) / k::double) v from t, n)
select round(avg(v), 9) auc, round(stddev_pop(v), 9) std, round(max(v), 9) most from y"""


def best_confidence(spark, d):
    li = table(spark, d, "lineitem")
    return scores.best_confidence(li.select(F.expr("l_suppkey % 7").alias("way"), F.col("l_returnflag").alias("y"), F.when(F.col("l_quantity") > 25, "N").otherwise(F.when(F.col("l_linestatus") == "F", "A").otherwise("R")).alias("z")), ["way"], "y", "z").select("way", F.round("score", 9).alias("score"))


BEST_CONFIDENCE_SQL = """with x as (select l_suppkey % 7 way, l_returnflag y, case when l_quantity > 25 then 'N' when l_linestatus = 'F' then 'A' else 'R' end z from lineitem),
p as (select way, y, avg(case when y = z then 1.0::double else 0 end) s from x group by all), m as (select way, avg(s) s from p group by 1)
select way, round(s, 9) score from m order by s desc, way limit 1"""


def adaptation_scores(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 97 / 10).alias("o"), (F.col("p_partkey") % 89 / 10).alias("a"))
    return scores.adaptation_scores(p, "o", "a", 5.0, F.lit(6.0), 3.0).select("p_partkey", *[F.round(c, 3).alias(c) for c in ("original_scale", "adapt_werr", "score")])


ADAPT_SQL = """with p as (select p_partkey, p_partkey % 97 / 10.0::double o, p_partkey % 89 / 10.0::double a from part), s as (select p_partkey, (3 - least(3, abs(o - 5))) / 3 x, greatest(6 - a, 0) / 6 y from p)
select p_partkey, round(round(x, 4), 3) original_scale, round(round(y, 4), 3) adapt_werr, round(round(x * y, 4), 3) score from s"""


def best_by_dataset(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", F.expr("l_suppkey % 7").alias("config"), F.col("l_quantity").cast("long").alias("q"))
    return scores.best_by_dataset(li, ["config"], "l_returnflag", "q").select("l_returnflag", "config", F.round("q", 9).alias("q"))


BEST_DATASET_SQL = """with x as (select l_returnflag, l_suppkey % 7 config, cast(l_quantity as bigint) q from lineitem), p as (select l_returnflag, config, avg(q) q from x group by grouping sets ((l_returnflag, config), (config))),
r as (select *, row_number() over (partition by l_returnflag order by q desc, config) n from p) select l_returnflag, config, round(q, 9) q from r where n = 1"""


def compare_vocabularies(spark, d):
    """Words as order priorities by clerk status, met by two models of other luck."""
    li = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("word")).agg(F.count("*").alias("count"), F.count_if(F.col("l_returnflag") == "N").alias("k"), F.count_if(F.col("l_linestatus") == "O").alias("j"))
    a, b = (li.select("word", "count", (F.col(c) / F.col("count")).alias("accuracy")) for c in "kj")
    return scores.compare_vocabularies(a, b.where("word % 2 = 0"))


COMPARE_SQL = """with w as (select l_partkey word, count(*) n, count(*) filter (l_returnflag = 'N') k, count(*) filter (l_linestatus = 'O') j from lineitem group by 1 having l_partkey % 2 = 0)
select word, n count, k / n::double accuracy_a, j / n::double accuracy_b, j / n::double - k / n::double gain, 1 / n::double weight from w"""


def cut_statistics(spark, d):
    s = spans(spark, d).select("user_id", (F.col("s") - 1704067200).alias("s"), (F.col("e") - 1704067200).alias("e"), (F.col("cents") % 10).alias("score"))
    return scores.cut_statistics(s, ["user_id"], 5, 100)


CUT_SQL = f"""with {SPAN_SQL}, x as (select user_id, s - 1704067200 s, e - 1704067200 e, cents % 10 k from iv),
y as (select *, s - coalesce(lag(e) over (partition by user_id order by s, e), 0) g from x)
select user_id, cast(coalesce(sum(e - s) filter (e - s <= 100 and k >= 5), 0) as double) high, cast(coalesce(sum(e - s) filter (e - s <= 100 and k < 5), 0) as double) low,
cast(coalesce(sum(e - s) filter (e - s > 100), 0) as double) too_long, cast(coalesce(sum(g) filter (g > 0.01), 0) as double) deleted from y group by 1"""


def sentence_blocks(spark, d):
    """Order lines as sentences, quantities as tokens."""
    return records.sentence_blocks(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("n")), "l_orderkey", "l_linenumber", "n", 60, 49)


BLOCKS_SQL = """with recursive q as (select l_orderkey k, l_linenumber i, cast(l_quantity as bigint) n, row_number() over (partition by l_orderkey order by l_linenumber, cast(l_quantity as bigint)) r, count(*) over (partition by l_orderkey) t, max(cast(l_quantity as bigint)) over (partition by l_orderkey) m from lineitem where cast(l_quantity as bigint) > 0),
s as (select * from q where t > 1 and m <= 49),
f as (select k, r, t, i, i f, n a, 1 c, ((n >= 60 and t - r > 1 and 1 >= 2) or t = r) z, 0::bigint b from s where r = 1
union all select s.k, s.r, s.t, s.i, case when f.z then s.i else f.f end, case when f.z then s.n else f.a + s.n end, case when f.z then 1 else f.c + 1 end,
((case when f.z then s.n else f.a + s.n end) >= 60 and s.t - s.r > 1 and (case when f.z then 1 else f.c + 1 end) >= 2) or s.t = s.r, f.b + case when f.z then 1 else 0 end from f join s on s.k = f.k and s.r = f.r + 1)
select k l_orderkey, cast(b as integer) block, cast(f as bigint) "first", cast(i as bigint) "last", cast(a as bigint) tokens from f where z"""


def conversations_with_turns(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return records.with_turns(c, "turns", 3).select("conv_id", F.size("turns").cast("long").alias("n"))


def unmasked_records(spark, d):
    """A document's sentences are masked but for long ones; only the first four count."""
    t = table(spark, d, "documents").select("doc_id", F.transform(F.split("text", r"\. ", -1), lambda s: (F.length(s) > 80).cast("int")).alias("mask"))
    return records.unmasked(t, "mask", 4).select("doc_id")


def interleave(spark, d):
    s = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    from loquarium.operators import curation

    return records.interleaved(curation.round_robin(s, "c_mktsegment", "c_custkey"), "c_mktsegment", "rn").select("c_custkey", "step")


INTERLEAVE_SQL = """with r as (select c_custkey, c_mktsegment, row_number() over (partition by c_mktsegment order by c_custkey) rn from customer) select c_custkey, row_number() over (order by rn, c_mktsegment) - 1 step from r"""


def packed_lines(spark, d):
    """Subtitle lines of 42 characters, of whole texts: how many, and the longest."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    lines = records.packed_lines(words, 42)
    return table(spark, d, "conversations").select("conv_id", "turn", lines.alias("l")).select("conv_id", "turn", F.size("l").alias("n"), F.array_join("l", "\n").alias("lines"))


def restored_case(spark, d):
    """Words in small letters get the text's own letters back."""
    words = F.filter(F.split(F.regexp_replace("text", r"\s+", " "), " "), lambda w: w != "")
    text = F.array_join(words, " ")
    tokens = F.transform(words, lambda w: F.concat(F.lit("▁"), F.lower(w)))
    return table(spark, d, "conversations").select("conv_id", "turn", F.translate(F.array_join(records.restored_case(text, tokens), " "), "▁", "").alias("restored"))


def path_labels(spark, d):
    p = table(spark, d, "pages").select("page_id", F.col("url").alias("path"))
    return manifests.path_labels(p, 2).select("page_id", "label")


def entry_keys(spark, d):
    e = table(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, F.lit('{"text": "a", "duration": 1}')).otherwise(F.lit('{"text": "b"}')).alias("raw"))
    one = lambda k: manifests.lines_with_key(e, k).withColumn("key", F.lit(k))
    return one("text").unionByName(one("duration")).unionByName(one("offset"))


QUERIES = {
    "preferred_transcript": (preferred_transcript, PREFERRED_SQL),
    "full_paths": (full_paths, FULL_PATHS_SQL),
    "manifest_create": (manifest_create, MANIFEST_SQL),
    "shard_members": (shard_members, "select o_orderkey file_id, o_orderpriority member, l_linenumber segment from orders join lineitem on o_orderkey = l_orderkey where l_quantity > 45"),
    "bucket_batches": (bucket_batches, BATCH_SQL),
    "extra_model": (extra_model, EXTRA_SQL),
    "first_segments": (first_segments, "select l_orderkey, l_linenumber, l_partkey from lineitem qualify row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) <= 2"),
    "source_groups": (source_groups, f"with {SPAN_SQL} select user_id source, count(*) n, min(s) start, max(e) \"end\" from iv group by 1"),
    "rttm_lines": (rttm_lines, RTTM_SQL),
    "word_speakers": (word_speakers, WORD_SPEAKERS_SQL),
    "vad_detection_error": (vad_detection_error, VAD_ERROR_SQL),
    "remove_segments": (remove_segments, f"with {SPAN_SQL} select user_id, s, e from iv where s % 3 <> 0"),
    "contiguous_stamps": (contiguous_stamps, STAMPS_SQL),
    "manifest_eval": (manifest_eval, "select o_orderkey, case when o_orderkey % 3 = 0 then o_orderpriority else '' end pred_text from orders"),
    "result_table": (result_table, RESULT_SQL),
    "auc_pr": (auc_pr, f"with {SCORED_SQL}, {AP_SQL.format(p='p', y='y')}"),
    "auc_nt": (auc_nt, f"with {SCORED_SQL}, {AP_SQL.format(p='(1 - p)', y='1 - y')}"),
    "auc_yc": (auc_yc, YC_SQL),
    "best_confidence": (best_confidence, BEST_CONFIDENCE_SQL),
    "adaptation_scores": (adaptation_scores, ADAPT_SQL),
    "best_by_dataset": (best_by_dataset, BEST_DATASET_SQL),
    "compare_vocabularies": (compare_vocabularies, COMPARE_SQL),
    "cut_statistics": (cut_statistics, CUT_SQL),
    "sentence_blocks": (sentence_blocks, BLOCKS_SQL),
    "conversations_with_turns": (conversations_with_turns, "select conv_id, count(*) n from conversations group by 1 having count(*) >= 3"),
    "unmasked_records": (unmasked_records, "select doc_id from documents where len(list_filter(string_split(text, '. ')[1:4], lambda s: length(s) > 80)) > 0"),
    "interleave": (interleave, INTERLEAVE_SQL),
    "packed_lines": (packed_lines, None),
    "restored_case": (restored_case, r"select conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) restored from conversations"),
    "path_labels": (path_labels, "select page_id, string_split(url, '/')[3] as \"label\" from pages"),
    "entry_keys": (entry_keys, "select * from (values ('text', true, true), ('duration', true, false), ('offset', false, false)) t(\"key\", any_line, all_lines)"),
}
