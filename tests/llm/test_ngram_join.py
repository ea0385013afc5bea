"""The join against brute force over all pairs, and the exact remainder."""

import re

from pyspark.sql import functions as F

from linkmill.llm import ngram_join as J


def grams(text):
    w = re.findall(r"[a-z0-9]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def classes(rows):
    """Brute force: union of all pairs with similarity of at least 0.8."""
    sets, parent = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted(sorted(map(str, g)) for g in groups.values())


def test_classes_equal_brute_force(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    member, links = J.ngram_join(odd_docs)
    got = {}
    out = member.collect()
    assert len(out) == len(rows)
    for k, r in enumerate(out):
        got.setdefault(bytes(r["class_key"]) if r["class_key"] else ("none", k), []).append(str(r["doc_id"]))
    assert sorted(sorted(g) for g in got.values()) == classes(rows)
    assert links.where(F.col("jaccard") < 0.8).isEmpty() and links.where("a = b").isEmpty()
    linked = {r["doc_id"]: r["n_links"] for r in out if r["doc_id"] is not None}
    assert linked[2] > 0 and linked[3] == 0


def test_exact_remainder_joins_what_belongs_together(spark, monkeypatch):
    """Buckets whose members are all apart, in chunks of a few members: the links given out join the components as all links would."""
    import random

    r = random.Random(2)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base[: 60 - k % 7] + [f"t{k}"] * (k % 3)) for k in range(40)] + [" ".join(f"o{r.randrange(99)}" for _ in range(30)) for _ in range(5)]
    names = [f"{k:02d}".encode() for k in range(45)]
    rows = [(bucket, bytearray(names[k]), bytearray(f"{k % 11}".encode())) for bucket in (7, 8) for k in range(45) if bucket == 7 or k < 20]
    placed = spark.createDataFrame(rows, "bucket long, node binary, root binary")
    held = spark.createDataFrame([(bytearray(n), t) for n, t in zip(names, texts, strict=True)], "node binary, text string")
    sets = [grams(t) for t in texts]

    def joined(pairs):
        up = list(range(11))
        for i, j in pairs:
            a, b = (up[k % 11] for k in (i, j))
            up = [a if x == b else x for x in up]
        return [[up[i] == up[j] for j in range(11)] for i in range(11)]

    want = [(i, j) for j in range(45) for i in range(j) if i % 11 != j % 11 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for chunk in (256, 9):
        monkeypatch.setattr(J, "CHUNK", chunk)
        got = [(int(bytes(q["a"])), int(bytes(q["b"]))) for q in J._block_links(placed, held, 5, 0.8).collect()]
        assert set(got) <= set(want) and joined(got) == joined(want)
        if chunk == 256:
            assert len(got) <= 2 * 10 < len(want)


def test_counts_over_chunks_and_batches_equal_brute_force(spark, monkeypatch):
    """A class in many chunks, and Arrow batches of a few rows, so that blocks reach over them."""
    import random

    r = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    texts = {}
    for k in range(60):
        own = base[:]
        for _ in range(k % 4):
            own[r.randrange(80)] = f"e{r.randrange(9)}"
        texts[f"{k:02d}".encode()] = " ".join(own)
    classes_ = {n: b"00" if int(n) < 40 else b"40" if int(n) < 43 else b"43" for n in texts}
    roots = spark.createDataFrame([(bytearray(n), bytearray(c)) for n, c in classes_.items() if n != c], "node binary, root binary")
    held = spark.createDataFrame([(bytearray(n), t) for n, t in texts.items()], "node binary, text string")
    sets = {n: grams(t) for n, t in texts.items()}
    want = {n: c for n in texts if (c := sum(m != n and classes_[m] == classes_[n] and len(sets[m] & sets[n]) >= 0.8 * len(sets[m] | sets[n]) for m in texts))}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for chunk, batch in ((256, 10_000), (7, 10_000), (7, 5), (256, 3)):
            monkeypatch.setattr(J, "CHUNK", chunk)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert {bytes(q["node"]): q["n_links"] for q in J.link_counts(roots, held, 5, 0.8).collect()} == want
            assert J.all_links(roots, held, 5, 0.8).count() == sum(want.values()) // 2
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_one_of_each_class_stays(odd_docs, spark):
    kept = J.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    brute = classes([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert len(rows) == len(brute)
    assert J.keep_one(odd_docs.limit(0)).count() == 0


def test_plan_meets_recall():
    for threshold in (0.8, 0.9):
        bands, rows = J.band_plan(threshold, 0.999, 128)
        assert bands * rows <= 128 and 1 - (1 - threshold**rows) ** bands >= 0.999


def test_links_of_a_large_group_equal_brute_force(spark):
    import random
    from collections import Counter

    r = random.Random(11)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for k in range(400):
        text = base[:]
        for _ in range(1 + k % 4):
            text[r.randrange(100)] = f"e{r.randrange(30)}"
        texts.append(" ".join(text))
    texts += ["one pair of short texts with a few words " + w for w in ("more here", "more")] + texts[:3]
    sets = [grams(t) for t in texts]
    want = {frozenset((texts[i], texts[j])) for j in range(len(texts)) for i in range(j) if texts[i] != texts[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    degree = Counter(t for pair in want for t in pair)
    member, links = J.ngram_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = member.collect()
    assert {q["doc_id"]: q["n_links"] for q in rows} == {i: degree[t] for i, t in enumerate(texts)}
    text_of = {bytes(q["node"]): texts[q["doc_id"]] for q in rows}
    got = [frozenset((text_of[bytes(q["a"])], text_of[bytes(q["b"])])) for q in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 10 * len(set(texts))
