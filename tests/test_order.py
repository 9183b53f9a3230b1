"""Orders within groups of any size against plain Python, over several ranges and blocks."""

import random

from rulelake.operators.order import carried_forward, few, next_smaller, ranked_within

SCHEMA = "g string, i int, v int, name string, _p int"


def rows(seed, n=400):
    rng = random.Random(seed)
    places = {}
    out = []
    for k in range(n):
        g = rng.choice(["hot", "hot", "hot", "a", "b", None])
        places[g] = places.get(g, -1) + 1
        out.append((g, places[g], rng.choice([None, *range(50)]), f"n{k}", 7))
    rng.shuffle(out)
    return out


def test_places_and_carried_values(spark):
    data = rows(1)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    want, last = {}, {}
    for g, i, v, name, _ in sorted(data, key=lambda r: (r[0] or "", r[1])):
        last[g] = v if v is not None else last.get(g)
        want[name] = (i, last[g])
    named = df.where("g is not null").drop("_p")
    got = {r["name"]: r["place"] for r in ranked_within(named, "g", ["i"], "place").collect()}
    assert got == {k: v[0] for k, v in want.items() if k in got} and len(got) == named.count()
    got = {r["name"]: r["c"] for r in carried_forward(named, "g", ["i"], "v", "c").collect()}
    assert got == {k: v[1] for k, v in want.items() if k in got}
    assert ranked_within(named.limit(0), "g", ["i"], "place").count() == 0


def test_the_first_smaller_value_after(spark):
    data = [r for r in rows(2) if r[0] is not None and r[2] is not None]
    df = spark.createDataFrame(data, SCHEMA)
    want = {}
    for g, i, v, name, _ in data:
        later = [(j, m) for h, j, u, m, _ in data if h == g and j > i and u < v]
        if later:
            want[name] = min(later)[1]
    for block in (1024, 5):
        assert {r["name"]: r["other"] for r in next_smaller(df, "g", "i", "v", "name", block=block).collect()} == want


def test_a_few_of_each_group(spark):
    data = rows(3)
    got = {r["g"]: r["l"] for r in few(spark.createDataFrame(data, SCHEMA).where("v is not null"), "g", "name", 4, last=False).collect()}
    assert got == {g: sorted(n for h, _, v, n, _ in data if h == g and v is not None)[:4] for g in got}
