"""Queries on votes, scores and agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.voting import POISSON, b_cubed, bootstrap, last_answers, majority, named_unit, poisson_weight, ratio
from ..sources.tables import table
from .base import V, decisions, query, rule_versions

VERDICTS = ["keep", "reject", "merge"]


def votes(spark: SparkSession, d: str) -> DataFrame:
    """The usable verdicts of the judges: one a document, candidate and judge."""
    answers = last_answers(table(spark, d, "judge_output").select("doc_id", "judge", "received_at", "output"), ["doc_id"], "judge", "received_at", "output")
    each = answers.select("doc_id", "judge", F.posexplode("output.candidates").alias("pos", "c"))
    verdict = F.regexp_replace(F.lower("c.verdict"), r"[\s\p{Z}\p{P}\p{S}\x{85}]+", "")
    usable = each.select("doc_id", "judge", "pos", F.col("c.candidate").alias("candidate"), verdict.alias("verdict")).where(F.col("verdict").isin(VERDICTS) & (F.col("candidate") >= 1))
    return usable.groupBy("doc_id", "candidate", "judge").agg(F.max(F.struct("pos", "verdict")).alias("x")).select("doc_id", "candidate", "judge", "x.verdict")


_VOTES = r"""with a as (select doc_id, judge, output from judge_output where doc_id is not null and judge is not null qualify row_number() over (partition by doc_id, judge order by received_at desc nulls last) = 1),
e as (select doc_id, judge, unnest(output.candidates) as c, generate_subscripts(output.candidates, 1) as pos from a),
u as (select doc_id, judge, pos, c.candidate as candidate, regexp_replace(lower(c.verdict), '[\s\p{Z}\p{P}\p{S}\x{85}]+', '', 'g') as verdict from e),
vote as (select doc_id, candidate, judge, max_by(verdict, pos) as verdict from u where verdict in ('keep', 'reject', 'merge') and candidate >= 1 group by all),
n as (select doc_id, candidate, verdict, count(*) as n, min(judge) as o from vote group by all),
m as (select doc_id, candidate, verdict as winner, n as votes from n qualify row_number() over (partition by doc_id, candidate order by n desc, o) = 1),
maj as (select * from m where votes >= 2)"""


@query(_VOTES + " select doc_id, candidate, winner as verdict, votes from maj")
def majority_verdicts(spark, d):
    return majority(votes(spark, d), ["doc_id", "candidate"], "verdict", "judge")


@query(_VOTES + " select doc_id, candidate, min(verdict) as verdict, count(*) as judges from vote group by all having count(distinct verdict) = 1 and count(*) >= 2")
def unanimous_verdicts(spark, d):
    g = votes(spark, d).groupBy("doc_id", "candidate").agg(F.min("verdict").alias("verdict"), F.count_distinct("verdict").alias("k"), F.count("*").alias("judges"))
    return g.where("k = 1 and judges >= 2").drop("k")


_SCORES = _VOTES + """, sc as (select judge, doc_id, count(*) filter (winner = 'keep') as key_, count(*) filter (winner = 'keep' and verdict = 'keep') as found, count(*) filter (winner <> 'keep' and verdict = 'keep') as false_,
 count(*) as judged, count(*) filter (verdict = winner) as correct from vote join maj using (doc_id, candidate) group by all)"""


def _scores(spark, d):
    v = votes(spark, d)
    m = majority(v, ["doc_id", "candidate"], "verdict", "judge").select("doc_id", "candidate", F.col("verdict").alias("winner"))
    key, mine = F.col("winner") == "keep", F.col("verdict") == "keep"
    return v.join(m, ["doc_id", "candidate"]).groupBy("judge", "doc_id").agg(
        F.count_if(key).alias("key"), F.count_if(key & mine).alias("found"), F.count_if(~key & mine).alias("false"), F.count("*").alias("judged"), F.count_if(F.col("verdict") == F.col("winner")).alias("correct")
    )


@query(_SCORES + """ select judge, sum(key_)::bigint as key_decisions, sum(found)::bigint as found, sum(false_)::bigint as false_found, sum(found) / nullif(sum(key_), 0) as recall, sum(found) / nullif(sum(found) + sum(false_), 0) as precision,
 round(sum(correct) / sum(judged), 9) as pooled, round(avg(correct / judged), 9) as per_document from sc group by judge""")
def judge_scores(spark, d):
    s = _scores(spark, d).groupBy("judge").agg(F.sum("key").alias("k"), F.sum("found").alias("f"), F.sum("false").alias("x"), F.sum("judged").alias("j"), F.sum("correct").alias("c"), F.avg(F.col("correct") / F.col("judged")).alias("m"))
    return s.select("judge", F.col("k").alias("key_decisions"), F.col("f").alias("found"), F.col("x").alias("false_found"), ratio(F.col("f"), F.col("k")).alias("recall"), ratio(F.col("f"), F.col("f") + F.col("x")).alias("precision"), F.round(F.col("c") / F.col("j"), 9).alias("pooled"), F.round("m", 9).alias("per_document"))


_BY_MODEL = _SCORES + """, j as (select judge, sum(found) / nullif(sum(key_), 0) as recall, sum(found) / nullif(sum(found) + sum(false_), 0) as precision from sc group by judge),
g as (select model, effort, j.* from judge join j using (judge))"""


def _by_model(spark, d):
    s = _scores(spark, d).groupBy("judge").agg(F.sum("key").alias("k"), F.sum("found").alias("f"), F.sum("false").alias("x"))
    s = s.select("judge", ratio(F.col("f"), F.col("k")).alias("recall"), ratio(F.col("f"), F.col("f") + F.col("x")).alias("precision"))
    return table(spark, d, "judge").select("judge", "model", "effort").join(s, "judge")


@query(_BY_MODEL + " select model, round(median(recall), 9) as median_, round(min(recall), 9) as least, round(max(recall), 9) as most, case when bool_or(precision is null) then null else round(min(precision), 9) end as worst_precision, count(*) as runs from g group by model having count(*) >= 2")
def model_spread(spark, d):
    g = _by_model(spark, d).groupBy("model").agg(F.median("recall").alias("m"), F.min("recall").alias("a"), F.max("recall").alias("b"), F.min("precision").alias("p"), F.bool_or(F.isnull("precision")).alias("n"), F.count("*").alias("runs"))
    return g.where("runs >= 2").select("model", F.round("m", 9).alias("median_"), F.round("a", 9).alias("least"), F.round("b", 9).alias("most"), F.when(~F.col("n"), F.round("p", 9)).alias("worst_precision"), "runs")


@query(_BY_MODEL + """, w as (select min(recall) filter (model = 'model-a') as worst, avg(recall) filter (model = 'model-b') as base from g), bound as (select least(base - 0.05, worst) as need from w)
select judge, round(recall, 9) as recall, coalesce(recall >= need - 1e-9, false) as passes from g, bound""")
def recall_gate(spark, d):
    """The looser of a baseline less a slack and today's worst is the bound; a missing figure fails."""
    g = _by_model(spark, d)
    bound = g.agg(F.least(F.avg(F.when(F.col("model") == "model-b", F.col("recall"))) - 0.05, F.min(F.when(F.col("model") == "model-a", F.col("recall")))).alias("need"))
    return g.crossJoin(F.broadcast(bound)).select("judge", F.round("recall", 9).alias("recall"), F.coalesce(F.col("recall") >= F.col("need") - 1e-9, F.lit(False)).alias("passes"))


@query("select model, case when count(distinct effort) = 1 and count(effort) = count(*) then min(effort) end as effort, count(*) as judges from judge group by model having count(*) >= 2")
def configurations(spark, d):
    one = (F.count_distinct("effort") == 1) & (F.count("effort") == F.count("*"))
    return table(spark, d, "judge").groupBy("model").agg(F.when(one, F.min("effort")).alias("effort"), F.count("*").alias("judges")).where("judges >= 2")


@query(_VOTES + """, k as (select doc_id, candidate, judge from vote where verdict = 'keep'), c as (select judge, count(*) as n from k group by judge),
p as (select a.judge as a, b.judge as b, count(*) as matched from k a join k b on a.doc_id = b.doc_id and a.candidate = b.candidate and a.judge < b.judge group by all)
select a, b, 2 * matched / (x.n + y.n) as stability from p join c x on x.judge = a join c y on y.judge = b""")
def judge_stability(spark, d):
    k = votes(spark, d).where("verdict = 'keep'")
    c = k.groupBy("judge").agg(F.count("*").alias("n"))
    p = k.select("doc_id", "candidate", F.col("judge").alias("a")).join(k.select("doc_id", "candidate", F.col("judge").alias("b")), ["doc_id", "candidate"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("m"))
    # a row a judge, of whom there are forty
    x, y = c.select(F.col("judge").alias("a"), F.col("n").alias("x")), c.select(F.col("judge").alias("b"), F.col("n").alias("y"))
    return p.join(F.broadcast(x), "a").join(F.broadcast(y), "b").select("a", "b", (2 * F.col("m") / (F.col("x") + F.col("y"))).alias("stability"))


@query(_VOTES + ", k as (select doc_id, candidate, min(judge) as judge, count(*) as n from vote where verdict = 'keep' group by all) select judge, count(*) as solo, count(*) filter (winner = 'keep') as kept from k left join m using (doc_id, candidate) where n = 1 group by judge")
def solo_candidates(spark, d):
    v = votes(spark, d)
    solo = v.where("verdict = 'keep'").groupBy("doc_id", "candidate").agg(F.min("judge").alias("judge"), F.count("*").alias("n")).where("n = 1")
    m = majority(v, ["doc_id", "candidate"], "verdict", "judge", least=1).select("doc_id", "candidate", "verdict")
    return solo.join(m, ["doc_id", "candidate"], "left").groupBy("judge").agg(F.count("*").alias("solo"), F.count_if(F.col("verdict") == "keep").alias("kept"))


_POISSON = " + ".join(f"(w >= {t})::int" for t in POISSON)


@query(_SCORES + f""", un as (select doc_id, count(*) filter (verdict = winner and vote.judge in (select judge from judge where model = 'model-a')) as ca, count(*) filter (vote.judge in (select judge from judge where model = 'model-a')) as ja,
 count(*) filter (verdict = winner and vote.judge in (select judge from judge where model = 'model-b')) as cb, count(*) filter (vote.judge in (select judge from judge where model = 'model-b')) as jb from vote join maj using (doc_id, candidate) group by doc_id),
nu as (select *, ('0x' || substr(md5(doc_id), 1, 15))::bigint % 2147483647 as u, ('0x' || substr(md5(doc_id), 16, 15))::bigint % 2147483647 as v from un), pw as (select s, ca, ja, cb, jb, (u + s * v) % 2147483647 as w from nu, range(1, 2001) t(s)),
dr as (select s, sum(ca * k) as ca, sum(ja * k) as ja, sum(cb * k) as cb, sum(jb * k) as jb from (select *, {_POISSON} as k from pw) group by s),
df as (select ca / nullif(ja, 0) - cb / nullif(jb, 0) as dd from dr), li as (select list_sort(list(dd)) as l, avg(case when dd > 0 then 1.0 else 0.0 end) as ahead from df where dd is not null)
select (select sum(ca) / nullif(sum(ja), 0) - sum(cb) / nullif(sum(jb), 0) from un) as difference, l[floor((len(l) - 1) * 0.025)::int + 1] as low, l[floor((len(l) - 1) * 0.975)::int + 1] as high, ahead from li""")
def model_bootstrap_documents(spark, d):
    """Model a against model b over 2,000 resamples of documents."""
    v = votes(spark, d)
    m = majority(v, ["doc_id", "candidate"], "verdict", "judge").select("doc_id", "candidate", F.col("verdict").alias("winner"))
    j = v.join(m, ["doc_id", "candidate"]).join(F.broadcast(table(spark, d, "judge").select("judge", "model")), "judge")
    right = F.col("verdict") == F.col("winner")
    units = j.groupBy("doc_id").agg(*[f for x in "ab" for f in (F.count_if(right & (F.col("model") == f"model-{x}")).alias(f"c{x}"), F.count_if(F.col("model") == f"model-{x}").alias(f"j{x}"))])
    return bootstrap(units.withColumn("unit", named_unit("doc_id")), "unit", ("ca", "ja"), ("cb", "jb"), 2000, poisson_weight)


@query(f"with {V}, b as (select v.slug as a, d.doc_id as b, count(*) as n from v join d using (ref) group by all), x as (select *, sum(n) over (partition by a) as na, sum(n) over (partition by b) as nb from b), s as (select sum(n * n / na) / sum(n) as p, sum(n * n / nb) / sum(n) as r from x) select round(p, 9) as precision, round(r, 9) as recall, round(2 * p * r / (p + r), 9) as f1 from s")
def grouping_b_cubed(spark, d):
    rows = rule_versions(spark, d).join(decisions(spark, d).select("ref", "doc_id"), "ref")
    return b_cubed(rows, "slug", "doc_id").select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("with d as (select distinct * exclude (side, side_rettet) from decision) select coalesce(kategori, '**all**') as kategori, count(*) as decisions, count(*) filter (udfald = 'vedtaget') as adopted, count(*) filter (citat_fundet) as located from d group by grouping sets ((kategori), ())")
def categories_and_all(spark, d):
    g = decisions(spark, d).rollup("kategori").agg(F.count("*").alias("decisions"), F.count_if(F.col("udfald") == "vedtaget").alias("adopted"), F.count_if("citat_fundet").alias("located"))
    return g.withColumn("kategori", F.coalesce("kategori", F.lit("**all**")))


@query("select event_type, user_id % 10 as audit, round(sum(value), 4) as cost, sum((props::json->>'k')::bigint)::bigint as calls, count(*) as steps from events group by all")
def cost_ledger(spark, d):
    k = F.from_json("props", "map<string,bigint>")
    return table(spark, d, "events").select("event_type", (F.col("user_id") % 10).alias("audit"), "value", k["k"].alias("k")).groupBy("event_type", "audit").agg(F.round(F.sum("value"), 4).alias("cost"), F.sum("k").alias("calls"), F.count("*").alias("steps"))
