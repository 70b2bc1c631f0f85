"""Spelling variants, Merkle manifests and exact search, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm import maxscore, merkle, queries, spelling_variants

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, word string, n long, pos long, leaf string, row long"


def documents(spark, rows):
    """Rows (doc_id, text, lang); the other columns have names that the operators use themselves."""
    filled = [(i, t, lang, "s", None if t is None else len(t), "x", 1, 2, "y", 3) for i, t, lang in rows]
    return spark.createDataFrame(filled, DOCUMENTS)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_minimal_acceptor_shares_tails():
    words = sorted({"".join(p) for p in ("abend", "abends", "lebend", "lebends", "end", "ends", "")})
    found = spelling_variants.minimal_acceptor(words)

    def accepted(state=0, head=""):
        if found.ends[state]:
            yield head
        for letter, to in found.arcs[state].items():
            yield from accepted(to, head + letter)

    assert sorted(accepted()) == words
    used, waiting = set(), [0]
    while waiting:
        state = waiting.pop()
        if state not in used:
            used.add(state)
            waiting += found.arcs[state].values()

    # As many states as there are different sets of tails.
    def tails(head):
        return frozenset(w[len(head) :] for w in words if w.startswith(head))

    heads = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(used) == len({tails(h) for h in heads})


@pytest.mark.parametrize("group_words", [8192, 30, 3])
def test_links_are_all_pairs_one_edit_apart(spark, group_words):
    rng = random.Random(1)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 8))) for _ in range(350)} | {"a" * k for k in range(1, 12)}
    words |= {"xy" * 70, "xy" * 70 + "y", "xy" * 35 + "z" + "xy" * 35, "q" * 300, "q" * 301}
    words = sorted(words)
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    found = [(r.a, r.b, r.n_a, r.n_b) for r in spelling_variants.links(table, group_words).collect()]
    place = {w: i for i, w in enumerate(words)}
    expected = {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}
    assert len(found) == len(expected) and {frozenset(f[:2]) for f in found} == expected
    assert all(place[a] == n_a and place[b] == n_b for a, b, n_a, n_b in found)


def brute_variants(rows):
    counts = {}
    for doc_id, text, _ in rows:
        for run in spelling_variants_runs(text or ""):
            run = run.translate(str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    formed = {}
    for w, n in counts.items():
        near = sorted((-m, v) for v, m in counts.items() if one_edit(v, w))
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        formed[w] = (form, n, len(near), -near[0][0] if form else None)
    found = set()
    for w, (form, n, n_near, form_n) in formed.items():
        root = w
        while formed[root][0]:
            root = formed[root][0]
        found.add((w, form, root, n, n_near, form_n))
    return found


def spelling_variants_runs(text):
    import re

    return re.findall(spelling_variants.RUN + "+", text)


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdé", k=7)) for _ in range(12)]
    weights = [3**k % 1000 for k in range(1, 13)]
    rows = [(i, " ".join(rng.choices(base, weights, k=80)) + " Straße, STRASSE×x " * 3, "de") for i in range(60)]
    typos = [w[:k] + w[k + 1 :] for w in base for k in (0, 3, 6)]
    rows += [(100 + i, " ".join(rng.choices(typos, k=60)), None) for i in range(6)]
    rows += [(None, "Nothing " * 7, None), (200, None, None), (201, "", None), (202, "a" * 100_000, None)]
    rows += [(203, "repeated repeated", "x")] * 4 + [(204, "longword " * 200 + "longwort " * 30 + "longwart " * 5, "en")]
    frame = documents(spark, rows).repartition(5)
    expected = brute_variants(rows)
    found = {tuple(r) for r in spelling_variants.variants(frame, group_words=10).collect()}
    assert found == expected and ("longwart", "longwort", "longword", 5, 1, 30) in found
    assert spelling_variants.variants(frame.filter("doc_id = -1")).collect() == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def proved(nodes):
    """The root of nodes, and of each the siblings on its way up."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    root, ways = proved([sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)])
    return root, [([nodes[i ^ 1]] if i ^ 1 < len(nodes) else []) + ways[i // 2] for i in range(len(nodes))]


@pytest.mark.parametrize("persisted", [2, 8])
def test_proofs_equal_whole_trees(spark, persisted):
    sizes = [(None, 1), ("a", 7), ("b", 8), ("z", 300), ("é", 33)]
    leaves = [((i * 7) % 301, lang, sha(f"{lang}{i}")) for lang, n in sizes for i in range(n)]
    leaves += [(5, "a", sha("twice"))] * 2 + [(None, "b", sha("no id"))]
    frame = spark.createDataFrame(leaves, "doc_id long, lang string, leaf string")
    found = merkle.proofs(merkle.build(frame, "lang", ["doc_id"], persisted=persisted))
    found = found.withColumn("proof", merkle.proof_digest(F.col("siblings"))).withColumn(
        "fold", merkle.folded(F.col("leaf"), F.col("siblings"))
    )
    trees = []
    for lang in [lang for lang, _ in sizes]:
        mine = sorted((d is not None, d or 0, leaf) for d, tree, leaf in leaves if tree == lang)
        trees.append((mine, *proved([leaf for *_, leaf in mine])))
    root, tops = proved([subroot for _, subroot, _ in trees])
    expected = sorted(
        (leaf, subroot, root, sha("".join(way + top)), root)
        for (mine, subroot, ways), top in zip(trees, tops)
        for (*_, leaf), way in zip(mine, ways)
    )
    assert sorted((r.leaf, r.subroot, r.root, r.proof, r.fold) for r in found.collect()) == expected


def test_lone_leaves_and_no_leaves(spark):
    frame = spark.createDataFrame([(1, None, sha("x")), (1, "a", sha("y"))], "doc_id long, lang string, leaf string")
    found = merkle.proofs(merkle.build(frame, "lang", ["doc_id"])).collect()
    assert {(r.leaf, r.subroot, r.root) for r in found} == {(x, x, sha(sha("x") + sha("y"))) for x in (sha("x"), sha("y"))}
    assert merkle.proofs(merkle.build(frame.filter("doc_id = 2"), "lang", ["doc_id"])).collect() == []


def best_by_hand(rows, k):
    sound = [
        (i, np.floor(256 * np.array(v, float)).astype(int))
        for i, v in rows
        if v is not None and None not in v and np.isfinite(v).all()
    ]
    width = max(len(v) for _, v in sound)
    table = np.stack([np.pad(v, (0, width - len(v))) for _, v in sound])
    found = []
    for place, (own, query) in enumerate(zip([i for i, _ in sound], table)):
        if own is None or own % 50:
            continue
        scores = table @ query
        others = [p for p in range(len(sound)) if p != place]
        others.sort(key=lambda p: (-scores[p], sound[p][0] is None, sound[p][0] or 0))
        found += [(own, rank + 1, sound[p][0], int(scores[p])) for rank, p in enumerate(others[:k])]
    return sorted(found, key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<float>, row long, rank int, terms string")


@pytest.mark.parametrize("settings", [{}, {"shard_rows": 40, "query_bytes": 300}])
def test_search_equals_brute_force(spark, settings, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", settings.get("shard_rows", maxscore.SHARD_ROWS))
    rng = np.random.default_rng(3)
    table = np.round(rng.normal(size=(600, 9)) * (rng.random((600, 9)) < 0.5), 2).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(table)]
    rows += [(1000 + i, table[50].tolist()) for i in range(200)]  # ties
    rows += [(100, table[100].tolist()), (None, table[100].tolist()), (None, None), (150, None), (200, [float("nan")] * 9)]
    rows += [(250, [None] + [1.0] * 8), (2000, []), (2001, [3.0]), (2050, [1.0, float("inf")]), (2100, [0.5, -0.5])]
    found = maxscore.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, **settings).collect()
    assert sorted((tuple(r) for r in found), key=repr) == best_by_hand(rows, 5)


def test_search_among_few_rows(spark):
    frame = vectors(spark, [(0, [1.0, -1.0]), (50, [-1.0, 0.0]), (7, [0.0, 0.0])])
    found = maxscore.top_k(frame, F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in found.collect()} == {(0, 1, 7, 0), (0, 2, 50, -65536), (50, 1, 7, 0), (50, 2, 0, -65536)}
    assert maxscore.top_k(frame.filter("vec_id < 0"), F.col("vec_id") % 50 == 0).collect() == []
    huge = vectors(spark, [(0, [3e38]), (1, [3e38])])
    assert [r.score for r in maxscore.top_k(huge, F.col("vec_id") == 0).collect()] == [maxscore.LIMIT**2]


def test_queries_have_their_columns(spark, tmp_path):
    rows = [(1, "Schiffahrt " * 6, "de"), (1, "Schiffahrt " * 6, "de"), (None, None, None), (14, "", "en"), (3, "w" * 50_000, "en")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    vectors(spark, [(0, [1.0]), (0, [1.0]), (1, None)]).write.parquet(f"{tmp_path}/embeddings.parquet")
    folder = str(tmp_path)
    assert queries.op11_spelling_variants(spark, folder).dtypes == [
        ("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    tree = queries.op12_merkle(spark, folder)
    assert tree.dtypes[:1] + tree.dtypes[-1:] == [("doc_id", "bigint"), ("verified", "boolean")]
    assert tree.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    tampered = {r.doc_id for r in tree.filter("not verified").collect()}
    assert tree.count() == 5 and tampered == {i for i in (1, 14, 3) if zlib.crc32(str(i).encode()) % 7 == 0}
    best = queries.op13_maxscore(spark, folder)
    assert best.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, best.collect())) == [(0, 1, 0, 65536)] * 2
