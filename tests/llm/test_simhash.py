import random
import re

import pytest
import xxhash

from marginfold.llm.components import connected_components
from marginfold.llm.simhash import fingerprint, links, near_duplicates, one_of_each_group

SCHEMA = "doc_id long, text string, fingerprint string, print int"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("text", ["", "One", "one TWO", "É é A b c d e", "a b c " * 40, None])
def test_fingerprint_equals_definition(text):
    assert fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


def _clustered(seed):
    rng = random.Random(seed)
    prints = {0}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            p = centre
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                p ^= 1 << rng.randrange(64) if rng.random() < 0.5 else 1 << rng.randrange(20)
            prints.add(p)
    return sorted(prints)


@pytest.mark.parametrize("full_bucket", [1, 4, 1000])
def test_links_keep_components_whole(spark, full_bucket):
    prints = _clustered(full_bucket)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    found = links(frame, full_bucket).collect()
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 for a, b in found)
    roots = {r["node"] % 2**64: r["root"] for r in connected_components(links(frame, full_bucket)).collect()}
    groups = {}
    for p, root in brute_components(prints).items():
        groups.setdefault(root, set()).add(p)
    got = {}
    for p, root in roots.items():
        got.setdefault(root, set()).add(p)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(g) for g in got.values()}


@pytest.mark.parametrize("full_bucket", [1, 1000])
def test_exploded_index_is_not_broadcast(spark, full_bucket):
    prints = spark.range(8).selectExpr("shiftleft(1L, cast(id as int)) AS print")
    plan = links(prints, full_bucket)._jdf.queryExecution().sparkPlan().toString()
    joined = [line for line in plan.splitlines() if "Join" in line and " Inner" in line]
    assert len(joined) == 1 and "SortMergeJoin" in joined[0]


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    frame = spark.createDataFrame([*path, *star, (5, 5), (2000, 2000), (None, 3)], "a long, b long")
    roots = dict(connected_components(frame).collect())
    assert roots == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert connected_components(frame.limit(0)).count() == 0


def _docs(spark):
    words = [f"w{i}" for i in range(400)]
    base = " ".join(words)
    near = " ".join([*words[:-1], "other"])
    rows = [(7, base), (3, base.upper().replace("W", "w")), (5, near), (9, ""), (8, None), (4, " \t\n"), (2, "alone here"), (2, "alone here"), (None, base)]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def test_near_duplicates_with_nulls_ties_and_repeats(spark):
    docs = _docs(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == 9
    by_id = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows}
    expected = brute_components({brute_fingerprint(t) for _, t, *_ in docs.collect()})
    least = {}
    for doc_id, text, *_ in docs.collect():
        root = expected[brute_fingerprint(text)]
        least[root] = min(least.get(root, 10**9), doc_id if doc_id is not None else 10**9)
    for doc_id, text, *_ in docs.collect():
        print_ = brute_fingerprint(text)
        assert by_id[doc_id] == (f"{print_:016x}", least[expected[print_]])
    assert near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = _docs(spark)
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    components = {r["component_id"] for r in near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(components)
