"""Token counts, the Merkle manifest and vector codes, against plain Python."""

import hashlib
import math
import os
import random
import uuid
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from checks.compare import duck, sorted_rows
from portledger.llm import merkle, token_counts, vector_codes
from portledger.llm.common import Scratch

SF_DIR = "/root/testdata/sf0.001"

TEXTS = [None, "", " ", "one  two", "one▁▁two", "A b C", "A b C", "<s> été </s>\n\n", "x" * 2_000_000, "word " * 300_000]


def documents(spark, texts=TEXTS, langs=("en", None, "de"), start=0):
    rows = [
        ((i if i not in (6,) else 5) + start, t, langs[i % len(langs)], "s" if i % 2 else None, i if i % 4 else None, "k", b"x", 1)
        for i, t in enumerate(texts)
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, leaf binary, n_tokens int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def scratch(spark):
    with Scratch(spark, "test") as s:
        yield s


# Token counts.


def pieces(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_tokenizer())
    return len(model.encode(text or ""))


def counted(docs, tokenizer, cache, scratch):
    rows = token_counts.token_counts(docs, tokenizer, cache, scratch).collect()
    return sorted((tuple(r) for r in rows), key=str)


def expected_counts(docs, count=pieces):
    rows = []
    for r in docs.collect():
        n = count(r["text"])
        rows.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 4096))
    return sorted(rows, key=str)


def test_token_counts_and_cache(spark, scratch):
    docs = documents(spark).unionByName(documents(spark, ["null id"]).selectExpr("cast(null as long) doc_id", "* except (doc_id)"))
    tokenizer = token_counts.Tokenizer(token_counts.default_tokenizer())
    cache = token_counts.TokenCountCache(spark, scratch.path("cache"))
    assert counted(docs, tokenizer, cache, scratch) == expected_counts(docs)
    # Null and empty are one content, and so are a blank and the sign the model puts for it.
    assert cache.counts(tokenizer.version).count() == len(TEXTS) + 1 - 3
    folder = scratch.path(f"cache/tokenizer={tokenizer.version}")
    runs = os.listdir(folder)
    # All is known: nothing is appended. New contents alone are.
    with Scratch(spark, "again") as second:
        assert counted(docs, tokenizer, cache, second) == expected_counts(docs)
    assert os.listdir(folder) == runs
    more = documents(spark, ["new one", "A b C", "new two"])
    with Scratch(spark, "more") as third:
        assert counted(more, tokenizer, cache, third) == expected_counts(more)
    new = [d for d in os.listdir(folder) if d not in runs]
    assert spark.read.parquet(*[f"{folder}/{d}" for d in new]).count() == 2
    cache.compact(tokenizer.version, "whole")
    assert os.listdir(folder) == ["run=whole"] and cache.counts(tokenizer.version).count() == len(TEXTS)


def test_token_counts_join_beyond_the_broadcast(spark, scratch, monkeypatch):
    monkeypatch.setattr(token_counts, "BROADCAST_DIGESTS", 2)
    docs = documents(spark, [f"text {i % 7}" for i in range(60)])
    tokenizer = token_counts.Tokenizer(token_counts.default_tokenizer())
    cache = token_counts.TokenCountCache(spark, scratch.path("cache"))
    assert counted(docs, tokenizer, cache, scratch) == expected_counts(docs)
    assert cache.counts(tokenizer.version).count() == 7


def test_token_counts_of_another_tokenizer(spark, scratch):
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    other = token_counts.Tokenizer(path)
    first = token_counts.Tokenizer(token_counts.default_tokenizer())
    cache = token_counts.TokenCountCache(spark, scratch.path("cache"))
    docs = documents(spark, [None, "", "a <|endoftext|> b", "A B", "a b", "a b"])
    counted(docs, first, cache, scratch)
    model = tokenizers.Tokenizer.from_file(path)
    count = lambda text: len(model.encode(text or "", add_special_tokens=False).ids)
    with Scratch(spark, "other") as second:
        assert counted(docs, other, cache, second) == expected_counts(docs, count)
    assert first.version != other.version and cache.counts(other.version).count() == 4


def test_token_counts_of_nothing(spark, scratch):
    tokenizer = token_counts.Tokenizer(token_counts.default_tokenizer())
    cache = token_counts.TokenCountCache(spark, scratch.path("cache"))
    assert counted(documents(spark).where("false"), tokenizer, cache, scratch) == []


def test_token_count_query(spark):
    df = entry.queries()["op11_token_counts"](spark, SF_DIR)
    assert sorted((tuple(r) for r in df.collect()), key=str) == expected_counts(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


# Manifest.


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_text(row):
    parts = []
    for c in ("doc_id", "source", "lang", "n_chars", "text"):
        v = row[c]
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha("".join(parts))


def climb(nodes):
    """Levels of a sequence, from the nodes themselves to the last one."""
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def path_of(levels, i):
    steps = []
    for nodes in levels[:-1]:
        run = i // 8 * 8
        steps.append((i - run, nodes[run:i] + nodes[i + 1 : run + 8]))
        i //= 8
    return steps


def expected_manifest(rows):
    rows = [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows]
    groups = {}
    for r in rows:
        r["leaf"] = leaf_text(r)
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
        trees[lang] = climb([r["leaf"] for r in groups[lang]])
    top = climb([trees[x][-1][0] for x in langs])
    root, out = top[-1][0], []
    for j, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            steps = path_of(trees[lang], i) + path_of(top, j)
            node = r["leaf"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                node = leaf_text({**r, "text": lower})
            for place, others in steps:
                node = sha("".join([*others[:place], node, *others[place:]]))
            proof = sha("".join("".join(o) for _, o in steps))
            out.append((r["doc_id"], r["leaf"], trees[lang][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def manifest_rows(manifest, scratch):
    return sorted((tuple(r) for r in manifest.witnesses(scratch).collect()), key=str)


def source_rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_appender_extends_witnesses():
    tree = merkle.Appender()
    digests = [sha(str(i)) for i in range(70)]
    for d in digests:
        tree.append(d)
    # The first run of runs is complete; the last six leaves have no sibling attached yet.
    assert len(tree.witness(tree.leaves[0])) == 2 and tree.witness(tree.leaves[69]) == []
    root = tree.close(merkle.levels_above(70))
    levels = climb(digests)
    assert root == levels[-1][0]
    for i, leaf in enumerate(tree.leaves):
        assert tree.witness(leaf) == path_of(levels, i)
        assert merkle.folded(digests[i], tree.witness(leaf)) == root
        assert merkle.folded(sha("other"), tree.witness(leaf)) != root


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_equals_brute_force(spark, scratch, height):
    texts = [f"Text {i}" if i % 5 else None for i in range(700)] + TEXTS
    docs = documents(spark, texts, ("en", "en", None, "en", "de", "", "en", "ü", "en"))
    nulls = spark.sql("select cast(null as long) doc_id, 'Null Id' text, cast(null as string) lang, 's' source, 1L n_chars")
    docs = docs.unionByName(nulls.union(nulls), allowMissingColumns=True)
    manifest = merkle.Manifest(spark, scratch.path("m"), height)
    manifest.append(docs, "all")
    got = manifest_rows(manifest, scratch)
    assert got == expected_manifest(source_rows(docs))
    assert {True, False} == {r[-1] for r in got}


def test_manifest_grows_by_appends(spark, scratch):
    parts = [documents(spark, [f"Text {i}" for i in range(n)], ("en", None, "de", "en"), s) for n, s in ((90, 0), (3, 90), (150, 93), (1, 243))]
    manifest = merkle.Manifest(spark, scratch.path("m"), 1)
    rows = []
    for i, part in enumerate(parts):
        manifest.append(part, f"p{i}")
        manifest.append(part, f"p{i}")
        rows += source_rows(part)
        assert manifest_rows(manifest, scratch) == expected_manifest(rows)
    with pytest.raises(ValueError):
        manifest.append(documents(spark, ["early"]), "late")
    # Closed blocks are written once.
    found = spark.read.option("recursiveFileLookup", "true").parquet(scratch.path("m/blocks")).where("size = 8")
    assert found.count() == found.select("key", "block").distinct().count()


def test_manifest_of_a_stream(spark, scratch):
    whole = documents(spark, [f"Text {i}" for i in range(120)])
    inbox = scratch.path("inbox")
    manifest = merkle.Manifest(spark, scratch.path("m"), 1)
    for i, (a, b) in enumerate(((0, 50), (50, 51), (51, 121))):
        rows = whole.where(f"doc_id >= {a} and doc_id < {b}").select(*merkle.FIELDS)
        rows.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        query = merkle.append_stream(stream, manifest, scratch.path("checkpoint"))
        query.awaitTermination()
    assert manifest_rows(manifest, scratch) == expected_manifest(source_rows(whole))


def test_manifest_of_little(spark, scratch):
    empty = merkle.Manifest(spark, scratch.path("empty"))
    empty.append(documents(spark).where("false"), "none")
    assert manifest_rows(empty, scratch) == []
    lone = merkle.Manifest(spark, scratch.path("lone"))
    docs = documents(spark, ["One"])
    lone.append(docs, "one")
    got = manifest_rows(lone, scratch)
    assert got == expected_manifest(source_rows(docs)) and got[0][1] == got[0][2] == got[0][3]


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_vector_codes"])
def test_queries_equal_their_sql(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    cur = duck(SF_DIR).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(columns, cur.fetchall())


def test_manifest_query_equals_brute_force(spark):
    got = sorted((tuple(r) for r in entry.queries()["op12_merkle_manifest"](spark, SF_DIR).collect()), key=str)
    assert got == expected_manifest(source_rows(spark.read.parquet(f"{SF_DIR}/documents.parquet")))


# Vector codes.


def expected_codes(rows):
    """``rows`` of (vec_id, vector, label), usable ones only."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[int(v) * 256 if abs(v) >= 2**53 else math.floor(256 * v) for v in r[1]] for r in rows]
    width = len(whole[0]) // 16
    parts = [[v[p * width : (p + 1) * width] for p in range(16)] for v in whole]
    books = [[list(x[p]) for x in parts[:64]] for p in range(16)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            groups = {}
            for x in parts:
                groups.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            for i, own in groups.items():
                books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    found = [[nearest(x[p], books[p]) for p in range(16)] for x in parts]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = sha(",".join(str(v) for b in books for e in b for v in e))
    fit = lambda e: e if e < 1 << 63 else None
    return sorted(
        ((r[0], "".join(f"{i:02x}" for _, i in f), fit(e), by_label[r[2]], digest) for r, f, e in zip(rows, found, errors)), key=str
    )


def vectors(spark, rows):
    rows = [(*r, "k", "c", 5) for r in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key string, code string, error int").repartition(3)


def codes(spark, rows, scratch):
    return sorted((tuple(r) for r in vector_codes.coded(vectors(spark, rows), scratch).collect()), key=str)


def rounded(rows):
    return [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("width,spread", [(1, 4.0), (3, 1.0), (4, 0.02)])
def test_orchard_search_is_exact(width, spread):
    rng = np.random.default_rng(width)
    entries = np.floor(rng.normal(size=(64, width)) * 256 * spread).astype(np.int64)
    entries[40:50] = entries[:10]
    x = np.concatenate([np.floor(rng.normal(size=(5_000, width)) * 256 * spread).astype(np.int64), entries, entries * 0 + 10_000])
    got, dist = vector_codes.Orchard(entries).nearest(x)
    gaps = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (got == gaps.argmin(axis=1)).all() and (dist == gaps.min(axis=1)).all()


def test_codes_equal_brute_force(spark, scratch):
    rnd = random.Random(5)
    rows = [(1000 - i, [rnd.gauss(0, 1) for _ in range(32)], rnd.choice([0, 1, None])) for i in range(300)]
    rows += [(5, rows[0][1], 1)] * 3 + [(2000 + i, rows[7][1], 0) for i in range(100)]
    rows += [(None, [rnd.gauss(0, 1) for _ in range(32)], None), (1, [0.0] * 32, 2)]
    good = rounded(rows)
    bad = [(0, None, 1), (0, [], 1), (0, [None] * 32, 1), (0, [float("nan")] * 32, 1), (0, [float("inf")] + [1.0] * 31, 1)]
    bad += [(9000, [1.0] * 16, 1), (0, [1.0] * 31, 1)]
    assert codes(spark, good + bad, scratch) == expected_codes(good)


def test_codes_of_huge_numbers(spark, scratch):
    rnd = random.Random(6)
    size = lambda: rnd.choice([1.0, 1e6, 3e9, 1e20])
    rows = rounded([(i, [rnd.gauss(0, 1) * size() for _ in range(16)], i % 3) for i in range(150)])
    rows += [(1000, [3.4e38] * 16, 7), (1001, [-3.4e38] * 16, None)]
    got, want = codes(spark, rounded(rows), scratch), expected_codes(rounded(rows))
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]


def test_codes_of_little(spark, scratch):
    assert codes(spark, [], scratch) == [] and codes(spark, [(1, None, 1)], scratch) == []
    few = [(i, [float(i)] * 16, 1) for i in range(3)]
    assert codes(spark, few, scratch) == expected_codes(few)
