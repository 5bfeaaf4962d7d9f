"""Repeats, whitening and the conversation trie against brute force, on small and odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import convtrie, runindex, whitening
from shelfwise.llm.common import Work

WHITE = " \t\n\v\f\r"


# --- repeats ----------------------------------------------------------------------


def plain_earlier(strings, width):
    seen, out = set(), []
    for s in strings:
        for i in range(len(s) + 1):
            part = s[i : i + width]
            out.append(len(part) == width and part in seen)
            if len(part) == width:
                seen.add(part)
    return out


def test_run_index_tells_which_strings_began_earlier():
    rng = random.Random(3)
    for _ in range(150):
        base = bytes(rng.choice(b"ab") for _ in range(40))
        strings = []
        for _ in range(rng.randrange(1, 12)):
            part = bytearray(base[rng.randrange(20) : rng.randrange(20, 41)])
            for _ in range(rng.randrange(3)):
                if part:
                    part[rng.randrange(len(part))] = rng.choice(b"abc")
            strings.append(bytes(part))
        index = runindex.RunIndex(strings)
        assert int(index.run_lengths.sum()) == index.size
        for width in (1, 3, 8):
            assert index.earlier(width).tolist() == plain_earlier(strings, width)


def test_run_index_of_repetitive_strings_is_small():
    rng = random.Random(1)
    base = bytes(rng.choices(b"abcdefgh", k=400))
    index = runindex.RunIndex([base[: 300 + i] for i in range(100)])
    assert len(index.run_bytes) < index.size / 20


def plain_repeats(rows, width=100):
    """Per (id, text): bytes, removed, runs, digest; ids in order, nulls last, then digests."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    distinct = {(i, (t or "").encode()) for i, t in rows}
    seen, out = set(), {}
    for i, body in sorted(distinct, key=lambda r: (r[0] is None, r[0] or 0, sha(r[1]))):
        gone = bytearray(len(body))
        for at in range(len(body) - width + 1):
            part = body[at : at + width]
            if part in seen:
                gone[at : at + width] = b"\1" * width
            seen.add(part)
        runs = sum(1 for k in range(len(body)) if gone[k] and not (k and gone[k - 1]))
        out[i, body] = (len(body), sum(gone), runs, sha(bytes(c for c, g in zip(body, gone, strict=True) if not g)))
    return sorted(((i, *out[i, (t or "").encode()]) for i, t in rows), key=str)


def repeated_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefé", k=rng.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (18, 25, 60, 200)]
    line = text(12)[:60]  # too short to go, in many documents
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            cut = rng.randrange(len(passage) // 3)
            parts += [passage[cut : len(passage) - rng.randrange(20)], line, text(rng.randrange(6))]
        rows.append((i * 7 % 60, " ".join(parts)))
    near = text(300)
    for i in range(20):
        rows.append((100 + i, near[: rng.randrange(1000)] + text(2) + near[rng.randrange(1000) :]))
    rows += [(200 + i, rows[3][1]) for i in range(5)]
    rows += [(300, "a" * 700), (301, "ab" * 350), (302, "a" * 99), (303, "a" * 100)]
    rows += [(310, None), (311, ""), (None, rows[5][1]), (None, None), (None, text(40)), (20, text(50)), (20, text(50))]
    rows.append(rows[0])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, monkeypatch, seed):
    if seed == 2:  # small blocks, sends and indexes; keys are divided to the last byte
        monkeypatch.setattr(runindex, "HASHED", 700)
        monkeypatch.setattr(runindex, "SENT", 90)
        monkeypatch.setattr(runindex, "INDEXED", 2_000)
        monkeypatch.setattr(runindex, "LOOKED_AT", 1)
        monkeypatch.setattr(runindex, "CROWDED", 0.0)
    rows = repeated_texts(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    frame = frame.withColumn("t1", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("id", F.lit(2))
    got = runindex.without_repeats(frame, Work(spark))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.select(names).collect()), key=str) == plain_repeats(rows)
    sizes = got.select(F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"]).alias("n"), "n_removed")
    assert sizes.filter("n != n_removed").count() == 0


def test_crowded_keys_are_divided_and_strings_keep_their_keys():
    rng = random.Random(5)
    line = bytes(rng.choices(b"abcdefgh", k=60))
    texts = [bytes(rng.choices(b"abcdefgh", k=80)) + line + bytes(rng.choices(b"abcdefgh", k=80)) for _ in range(50)]
    plain = runindex.Stretches.joined(list(runindex.stretches(texts, np.zeros(0, np.uint64))))
    keys, counts = np.unique(plain.key, return_counts=True)
    hot = keys[counts > 5]
    assert len(hot)
    divided = runindex.Stretches.joined(list(runindex.stretches(texts, hot)))
    assert divided.count.sum() == plain.count.sum() == sum(len(t) - 99 for t in texts)
    assert not np.isin(divided.key, hot).any()


def test_repeats_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert runindex.without_repeats(frame, Work(spark)).count() == 0


# --- whitening --------------------------------------------------------------------


def plain_whitening(vectors):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = (x - total // n) - (total - total // n * n) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return centred, values[::-1], axes[:, ::-1], [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, total, strict=True)) for r in x]


def test_whitening_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((300, 40)) @ np.diag(np.linspace(0.2, 3, 40))
    bad = [(900, None), (901, []), (902, [1.0] * 39 + [None]), (903, [1.0] * 39 + [float("nan")])]
    bad += [(904, [float("inf")] + [0.0] * 39), (905, [1.0] * 12)]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(None, vectors[0].tolist()), (7, vectors[7].tolist())]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(5)
    got = whitening.whitened(frame.withColumn("x", F.lit(1)), Work(spark)).toPandas()
    centred, values, axes, deviations = plain_whitening([v for _, v in rows])
    assert len(got) == len(rows) * 32 and got.identity_error.max() < 1e-9 and got.n.unique().tolist() == [len(rows)]
    want = {(i, k + 1): w for (i, _), c in zip(rows, centred, strict=True) for k, w in enumerate(c @ axes / np.sqrt(values)) if k < 32}
    sign = {}
    for r in got.itertuples():
        i = None if r.vec_id != r.vec_id else int(r.vec_id)
        w = want[i, r.component]
        s = sign.setdefault(r.component, np.sign(w * r.whitened))
        assert abs(s * r.whitened - w) < 1e-8
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-10
    by_id = {i: d for (i, _), d in zip(rows, deviations, strict=True)}
    assert all(by_id[None if a != a else int(a)] == d for a, d in zip(got.vec_id, got.deviation, strict=True))


def test_whitening_of_equal_variances_and_of_too_few_directions(spark):
    cross = [(i, (np.eye(4)[i % 4] * (1 if i < 4 else -1)).tolist() + [5.0]) for i in range(8)]  # no variance in the last
    frame = spark.createDataFrame(cross, "vec_id long, embedding array<float>")
    got = whitening.whitened(frame, Work(spark)).toPandas()
    assert sorted(got.component.unique()) == [1, 2, 3, 4] and got.identity_error.max() < 1e-12
    assert np.allclose(got.explained, 0.25)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_whitening_without_variance_has_no_components(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whitened(frame, Work(spark)).collect() == []


# --- conversation trie ------------------------------------------------------------


def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(np.fix(c / 20)) * 20
        whole[c] = tuple(own.get(base, [])[:h] + t[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in whole.items():
        ends[t].append(c)
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    count = lambda p: sum(1 for w in "".join(" " if ch in WHITE else ch for ch in p[-1][1]).split(" ") if w) if p else 0
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members[p]) - 1) * count(p)
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-25, 140), 2**40 + 3]:
        for t in range(rng.choice([1, 1, 2, 4, 9])):
            text = rng.choice(["yes", "no it is", "a\x1cb c", "", "x y z w"]) if t < 3 else f"w{rng.randrange(3)} é"
            rows.append((c, t, rng.choice(["user", "bot"]) if rng.random() < 0.1 else ["user", "bot"][t % 2], text))
    rows += [(500 + i, t, "user", f"same {t}") for i in range(80) for t in range(6)]
    rows += [(None, 1, "user", "lost"), (700, None, None, None), (700, 3, "user", "b"), (701, None, "user", None)]
    return rows


@pytest.mark.parametrize("parts", [1, 9])
def test_trie_equals_brute_force(spark, parts):
    rows = conversations(parts)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    frame = frame.withColumn("key", F.lit("k")).withColumn("depth", F.lit(0))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",)}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in convtrie.trie_nodes(frame, Work(spark)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before["spark.sql.shuffle.partitions"])
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == plain_trie(rows)


def test_trie_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert convtrie.trie_nodes(frame, Work(spark)).count() == 0


def test_findclose_equals_a_stack():
    rng = random.Random(4)
    for size in (1, 2, 40, 3000):
        bits, depth = [], 0
        while len(bits) < 2 * size - depth:
            up = depth == 0 or (rng.random() < 0.55 and len(bits) + depth < 2 * size)
            bits.append(up)
            depth += 1 if up else -1
        bits += [False] * depth
        bits = [True, *bits, False]
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.array(sorted(want))
        got = convtrie.Parentheses(np.array(bits)).findclose(opens)
        assert got.tolist() == [want[i] for i in opens.tolist()]
