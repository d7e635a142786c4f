"""The manifest against plain Python."""

import hashlib
import zlib

import pytest

from encore.llm import merkle
from encore.llm.merkle import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """The root of a list of digests and for each of them the (left, right) siblings up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        for i, place in enumerate(at):
            run, slot = runs[place // 16], place % 16
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[i] = place // 16
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append((row, leaf(row, row[1])))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for name in names:
        trees[name].sort(key=lambda t: (t[0][0] is not None, t[0][0] or 0, t[1]))
        found[name] = climb([d for _, d in trees[name]])
    root, above = climb([found[n][0] for n in names])
    out = []
    for name, top in zip(names, above, strict=True):
        subroot, paths = found[name]
        for (row, own), path in zip(trees[name], paths, strict=True):
            path = path + top
            now = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None:
                now = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]))
            for left, right in path:
                now = h(left, now, right)
            out.append((row[0], own, subroot, root, h(*(a + b for a, b in path)), now, now == root))
    return sorted(out, key=str)


def check(spark, rows, schema=SCHEMA):
    got = manifest(spark.createDataFrame(rows, schema)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    assert sorted(map(tuple, got.collect()), key=str) == plain([r[:5] for r in rows])


def test_against_plain_python(spark):
    rows = [(k * 7 - 300, f"Text {k} É" if k % 3 else f"small {k}", "en", "hot" if k % 3 else f"s{k % 4}", k) for k in range(900)]
    rows += [(5000 + k, "One", None, f"single {k}", None) for k in range(20)]
    check(spark, rows)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(None, None, None, None, None)] * 3 + [(1, "Same", "en", "a", 4)] * 20 + [(1, "Other", "en", "a", 5), (2, "", "en", "", 0)]
    rows += [(3, "X" * 300_000, "", None, 1), (4, "Ä", "ü", "ä", 1), (5, "b", "c", "Z", 1), (6, "b", "c", "z", 1)]
    schema = f"{SCHEMA}, leaf string, digest int, n int, tree string, place int, path string"
    check(spark, [(*r, "x", 1, 2, "t", 3, "p") for r in rows], schema)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_around_a_run(spark, n):
    check(spark, [(k, f"T{k}", "en", "s", k) for k in range(n)])


def test_missing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "A"), (2, None)], "doc_id long, text string")
    got = manifest(docs).select("leaf").collect()
    assert {r[0] for r in got} == {leaf((1, "A", None, None, None), "A"), leaf((2, None, None, None, None), None)}
    empty = manifest(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[-1] == "verified"


def test_no_window_holds_a_source(spark):
    nodes = spark.range(5000).selectExpr("0 as tree", "id as place", "5000L as n", "string(id) as digest")
    plan = merkle._with_siblings(nodes)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("], [block#" in w for w in windows), windows  # the constant tree is left out
