"""The pipeline's stages against plain versions, and the registered queries against their SQL."""

import collections
import hashlib
import os
import re

import duckdb
import pytest
from test_small import WORD, brute_counts, brute_groups, empty, odd

import corpus_pipeline
from shelfwise.llm import linededup, packing
from shelfwise.llm.common import Work, table
from shelfwise.llm.oracles import ORACLES
from shelfwise.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def without_lines(rows):
    """Texts after the removal of recurring lines, with dictionaries, from the definition of a template."""
    docs, places, leaves = collections.defaultdict(set), collections.defaultdict(list), collections.defaultdict(set)
    for i, text in rows:
        for at, line in enumerate(text.split("\n")):
            form = tuple("<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line))
            if form:
                docs[form].add(i)
                places[form].append((i, at))
                leaves[len(form), form[: linededup.DEPTH]].add(form)
    templates = collections.defaultdict(list)
    for forms in leaves.values():
        owners = collections.defaultdict(set)
        for f in forms:
            for place in enumerate(f):
                owners[place] |= docs[f]
        for f in forms:
            stays = [w != "<*>" and (len(forms) == 1 or len(owners[k, w]) >= linededup.MIN_DOCS) for k, w in enumerate(f)]
            template = tuple(w if c else "<*>" for w, c in zip(f, stays, strict=True))
            templates[len(f), f[: linededup.DEPTH], template].append(f)
            if len(f) >= linededup.LONG_TOKENS and "<*>" not in f:
                templates["long", f].append(f)
    gone = set()
    for key, forms in templates.items():
        template = key[-1]
        fixed, size = sum(w != "<*>" for w in template), len(template)
        share = linededup.MIN_CONSTANT_SHORT if size < linededup.MIN_TOKENS else linededup.MIN_CONSTANT
        if key[0] == "long":
            least = linededup.LONG_DOCS
        elif size < linededup.MIN_TOKENS:
            least = linededup.MIN_DOCS_SHORT
        else:
            least = linededup.MIN_DOCS if fixed == size else linededup.MIN_DOCS_VARIABLE
        if fixed >= share * size and len(set().union(*(docs[f] for f in forms))) >= least:
            gone |= set(sorted(p for f in forms for p in places[f])[1:])
    out = {}
    for i, text in rows:
        lines = text.split("\n")
        left = [x for at, x in enumerate(lines) if (i, at) not in gone]
        if len(left) == len(lines) or WORD.search("\n".join(left)):
            out[i] = "\n".join(left)
    return out


@pytest.mark.parametrize("again", [1, 5])
def test_a_document_counts_once_however_often_it_has_a_line(spark, again):
    """Nine documents differ in a colour that one of them, a tenth, may have on several lines."""
    colours = "blue green pink grey white black brown lilac olive".split()
    texts = [f"p q r {c} s t u v w x y z" for c in colours] + ["\n".join(["p q r red s t u v w x y z"] * again)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in linededup.without_recurring_lines(frame, Work(spark)).collect()}
    assert sum(r["n_dropped"] for r in got.values()) == 8 + again
    assert {i: r["text"] for i, r in got.items() if r["text"]} == without_lines(rows)


def test_crowded_lines_are_like_others(spark, monkeypatch):
    rows = [(i, f"the same long line that all of these documents have got\nown {i} words {i} x{i}\na b c d {i}") for i in range(40)]
    rows += [(100 + i, "p q r s t\nthe other long line that only two of these documents have got") for i in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for share in (0.0, 0.5, 1.0):
        monkeypatch.setattr(linededup, "CROWDED", share)
        got = linededup.without_recurring_lines(frame, Work(spark)).collect()
        want = without_lines(rows)
        assert {r["doc_id"]: r["text"] for r in got if WORD.search(r["text"])} == want


def test_stages_take_odd_and_empty_tables(spark):
    """Null ids and texts, repeated rows, clashing columns; and no rows at all."""
    work = Work(spark)
    for start in (odd(spark), empty(spark)):
        docs, rows = start, start.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            alone = stage(spark, start, SF_DIR)
            assert alone.columns == start.columns and alone.count() <= 2 * rows
            docs = work.keep(stage(spark, docs, SF_DIR))
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count() == 0
        packed = corpus_pipeline.STAGES[-1][1](spark, start, SF_DIR)
        assert (packed.count() >= rows) if rows else packed.count() == 0


def copies(row, rate):
    digest = hashlib.md5(f"20011104:{row['doc_id']}:{row['text']}".encode()).hexdigest()
    return int(rate) + (int(digest[:13], 16) / 2**52 < rate - int(rate))


def test_stages_equal_plain_versions(spark):
    work, docs = Work(spark), table(spark, SF_DIR, "documents")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = work.keep(stage(spark, docs, SF_DIR))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        after[name], docs = out.collect(), out
    first = {r["doc_id"]: r for r in table(spark, SF_DIR, "documents").collect()}

    kept = {r["doc_id"] for r in after["quality_rules"]}
    for i, row in first.items():
        n, _, symbols, _, repeated = brute_counts(row["text"])
        if n < 50 or 2 * repeated > n:
            assert i not in kept
        elif not symbols and (r := 100 * repeated) <= 10 * n:
            assert i in kept, (i, n, r)

    want = without_lines([(r["doc_id"], r["text"]) for r in after["quality_rules"]])
    assert {r["doc_id"]: r["text"] for r in after["line_dedup"]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after["line_dedup"])

    groups = brute_groups([(r["doc_id"], r["text"]) for r in after["line_dedup"]], 5, 80)
    assert {r["doc_id"] for r in after["minhash_near_dedup"]} == {g[0] for g in groups if g[0] == g[2]}

    rows = after["minhash_near_dedup"]
    taken = collections.Counter(r["doc_id"] for r in after["source_mix"])
    size = collections.Counter()
    for r in rows:
        size[r["source"]] += len(WORD.findall(r["text"]))
    from shelfwise.llm.mixing import targets

    frame = spark.createDataFrame(list(size.items()), "source string, source_size long")
    rate = {r["source"]: r["rate"] for r in targets(frame).collect()}
    assert taken == {r["doc_id"]: k for r in rows if (k := copies(r, rate[r["source"]]))}

    encode = packing.encoder(packing.VOCABULARY, packing.RANKS).tokenizer.encode
    total = sum(len(encode(r["text"], add_special_tokens=False).ids) + 1 for r in after["source_mix"])
    packed = after["best_fit_packing"]
    assert sum(r["length"] for r in packed) == total
    fill = collections.Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024 and len(fill) <= 1.1 * total / 1024 + 1


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for part in ("documents", "pages", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {part} AS SELECT * FROM '{SF_DIR}/{part}.parquet'")
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, df.select(*names).collect()), key=key) == sorted(cursor.fetchall(), key=key)
