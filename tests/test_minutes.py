"""Queries on quotes in minutes: documents read whole and by blocks alike, odd rows, and what they shuffle."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rulelake.operators.locating import containing, occurrences
from rulelake.plans import minutes

SMALLEST, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
here = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def shuffled(spark, name):
    """Bytes a query shuffles, over those of the table it reads."""
    told = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = told()
    entry.queries()[name](spark, SMALL).write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return (told() - before) / os.path.getsize(f"{SMALL}/decision.parquet")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Decisions without rank, document, number, page or words, on several pages, and with one number for several."""
    path = str(tmp_path_factory.mktemp("odd"))
    d = spark.read.parquet(f"{SMALLEST}/decision.parquet").where("doc_id = 'samlede-vedtagelser' or rank < 3").limit(400).cache()
    a = d.orderBy("ref").limit(40)
    odd = [a.withColumn("rank", F.lit(None).cast("int")), a.withColumn("doc_id", F.lit(None).cast("string")), a.withColumn("side", F.col("side") + 1), a.withColumn("side", F.lit(None).cast("int"))]
    odd += [a.withColumn("ref", F.concat("ref", F.lit("x"))).withColumn(c, F.lit(v)) for c, v in (("citat", None), ("citat", "..."), ("tekst", None), ("citat", "og"), ("citat", "Og  DEN"))]
    for i, x in enumerate(odd):
        odd[i] = x.withColumn("ref", F.concat("ref", F.lit(f"/{i}"))) if i not in (2, 3) else x
    odd.append(a.withColumn("ref", F.lit(None).cast("string")).limit(1))
    for x in odd:
        d = d.unionByName(x.select([F.col(c).cast(t) for c, t in d.dtypes]))
    d.coalesce(1).write.parquet(f"{path}/decision.parquet")
    return path


def rows_of(df):
    return sorted(map(str, df.collect()))


@here
@pytest.mark.parametrize("around", [False, True])
@pytest.mark.parametrize("cite", [False, True])
def test_whole_and_by_blocks(spark, odd, cite, around):
    for d in (odd, SMALLEST):
        one, other = (rows_of(minutes._read(spark, d, cite=cite, around=around, whole=w).drop("doc")) for w in (1 << 40, 0))
        assert one == other and len(one) > 300


@here
def test_odd_rows_as_in_sql(spark, odd):
    con = duckdb.connect()
    con.execute(f"create view decision as select * from '{odd}/decision.parquet/*.parquet'")
    want = sorted(map(str, con.execute(entry.oracle_sql()["quotes_in_minutes"]).fetchall()))
    for w in (1 << 40, 0):
        got = minutes._read(spark, odd, cite=False, whole=w).select(F.col("key").alias("ref"), F.col("pos").isNotNull().alias("found"), "pos").collect()
        assert sorted(str(tuple(r)) for r in got) == want


@here
def test_pages_against_every_document_read(spark, odd):
    rows = minutes._said(spark.read.parquet(f"{odd}/decision.parquet")).where("doc is not null").collect()
    docs = {}
    for r in rows:
        docs.setdefault(r["doc"], {}).setdefault((r["rank"] is None, r["rank"], r["key"] is None, r["key"] or "", r["one"]), []).append(r)
    want = []
    for doc, decided in docs.items():
        least = {}
        for rs in decided.values():
            for r in rs:
                if r["page"] is not None:
                    least[r["key"]] = min(r["page"], least.get(r["key"], r["page"]))
        order = [decided[k][0] for k in sorted(decided, key=lambda k: (k[0], k[1] or 0, *k[2:]))]
        ws = [w for r in order for w in r["w"].split()]
        pages = [least.get(r["key"]) for r in order for _ in r["w"].split()]
        for r in order:
            q, cited = r["q"].split(), least.get(r["key"])
            if len(q) > 2:
                places = [(o[3], o[4], o[5]) for o in occurrences(q, ws, pages, 0, -(10**9), 10**9)]
            else:
                places = [(i, pages[i], [pages[i]]) for i in range(len(ws)) if q and ws[i : i + len(q)] == q]
            own = [p for p in places if cited is not None and cited in p[2]]
            want.append((r["key"], *((own[0][0], cited) if own else places[0][:2] if places else (None, None))))
    got = [tuple(r) for r in minutes._read(spark, odd).where("doc is not null").select("key", "pos", "page").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


@here
def test_quotes_held_whole_and_by_trigrams(spark, odd):
    dec = spark.read.parquet(f"{odd}/decision.parquet")
    sides = [dec.select(F.col("doc_id").alias("doc"), F.col("ref").alias("key"), F.col(c).alias("quote")) for c in ("citat", "tekst")]
    one, other = (rows_of(containing(*sides, whole=w)) for w in (1 << 40, 0))
    assert one == other and len(one) > 300


@here
@pytest.mark.parametrize("name", ["quote_passages", "covered_quotes", "quotes_in_minutes", "quote_pages", "corrections_matched"])
def test_texts_are_not_shuffled_again_and_again(spark, name):
    assert shuffled(spark, name) < 20


def broadcasts(spark, run):
    """The rows of each broadcast of what ``run`` does, with all joins allowed to broadcast that Spark thinks are small."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    bus.waitUntilEmpty(30_000)
    first = store.executionsCount()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    bus.waitUntilEmpty(30_000)
    done = store.executionsList()
    out = []
    for i in range(first, done.size()):
        of = done.apply(i).executionId()
        told, nodes = store.executionMetrics(of), store.planGraph(of).allNodes()
        for node in (nodes.apply(k) for k in range(nodes.size())):
            if node.name() == "BroadcastExchange":
                said = [told.get(m.accumulatorId()) for m in (node.metrics().apply(k) for k in range(node.metrics().size())) if m.name() == "number of output rows"]
                out += [int(x.get().replace(",", "")) for x in said if x.isDefined()]
    return out


@here
@pytest.mark.parametrize("name", ["quote_pages", "quotes_in_minutes", "covered_quotes", "quote_passages"])
def test_quotes_and_words_are_not_broadcast(spark, monkeypatch, name):
    read = minutes._read
    monkeypatch.setattr(minutes, "_read", lambda *a, **k: read(*a, **k | {"whole": 0}))
    decisions = spark.read.parquet(f"{SMALL}/decision.parquet").count()
    sent = broadcasts(spark, lambda: entry.queries()[name](spark, SMALL).write.format("noop").mode("overwrite").save())
    assert sent and max(sent) < decisions / 4  # documents are, quotes are not
