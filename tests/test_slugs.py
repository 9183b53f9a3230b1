"""Names of rules against the same rules followed one after the other."""

import random

from rulelake.operators.slugs import carried, successors, unique_slugs


def one_by_one(names, taken):
    used, out = set(taken), {}
    for turn, key, base in sorted((t, k, b) for k, b, t in names):
        slug, n = base, 1
        while slug in used:
            n += 1
            slug = f"{base}-{n}"
        used.add(slug)
        out[key] = slug
    return out


def test_free_names(spark):
    for seed in range(3):
        rng = random.Random(seed)
        bases = ["x", "x-2", "x-3", "x-2-2", "y", "y-1", "z"]
        names = [(f"k{i:02}", rng.choice(bases), rng.randint(0, 9)) for i in range(25)]
        taken = rng.sample(["x", "x-4", "x-2-3", "y-2", "z-7", "q"], 4)
        got = unique_slugs(spark.createDataFrame(names, "key string, base string, turn int"), spark.createDataFrame([(t,) for t in taken], "slug string"))
        assert {r["key"]: r["slug"] for r in got.collect()} == one_by_one(names, taken)
    assert unique_slugs(spark.createDataFrame([], "key string, base string, turn int"), spark.createDataFrame([], "slug string")).count() == 0


def test_names_are_carried_over(spark):
    def frame(rows, schema):
        return spark.createDataFrame([(a, r) for a, refs in rows.items() for r in refs.split()], schema)

    previous = frame({"a": "1 2 3", "b": "4", "c": "5 6", "d": "9"}, "slug string, ref string")
    new = frame({"p": "1 2 4", "q": "3", "r": "5", "s": "6 7", "t": "8", "u": "10 11"}, "name string, ref string")
    former = frame({"old": "8 12", "older": "8", "gone": "10 11 12", "none": "20"}, "slug string, ref string")
    rules, fates = carried(previous, new, former)
    assert {r["name"]: (r["slug"], r["how"]) for r in rules.collect()} == {
        "p": ("a", "inherited"), "q": (None, "minted"), "r": ("c", "inherited"), "s": (None, "minted"), "t": ("older", "revived"), "u": ("gone", "revived"),
    }
    assert {r["slug"]: (r["fate"], r["to"]) for r in fates.collect()} == {"a": ("inherited", None), "b": ("alias", "a"), "c": ("inherited", None), "d": ("orphaned", None)}


def test_where_former_names_lead(spark):
    former = spark.createDataFrame([("f1", "c", "n1", "l9"), ("f2", "c", "n", "l1"), ("f3", "c", "n1", "l1"), ("f4", "c", "n2", None), ("f5", "d", "n1", "gone")], "slug string, category string, name string, to string")
    refs = spark.createDataFrame([("f1", "1"), ("f1", "2"), ("f1", "3"), ("f2", "90"), ("f3", "7"), ("f4", "8"), ("f5", "8")], "slug string, ref string")
    live = spark.createDataFrame([("l1", "c", "n1"), ("l2", "c", "n2"), ("l3", "c", "n2")], "slug string, category string, name string")
    held = spark.createDataFrame([("l1", "1"), ("l2", "2"), ("l2", "3")], "slug string, ref string")
    living = spark.createDataFrame([(str(i),) for i in range(1, 9)], "ref string")
    got = {r["slug"]: (r["successor"], r["reason"]) for r in successors(former, refs, live, held, living).collect()}
    assert got == {"f1": ("l2", "holder"), "f2": ("l1", "kept"), "f3": ("l1", "namesake"), "f4": (None, "retired"), "f5": (None, "retired")}
