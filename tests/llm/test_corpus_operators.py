"""Operators that compare documents with each other, against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import duck, sorted_rows
from portledger.llm import ann, line_dedup, ngram_join, suffix_dedup
from portledger.llm.common import connected_components

SF_DIR = "/root/testdata/sf0.001"


def documents(spark, rows):
    schema = "doc_id long, text string, node string, tie string, repeats int"
    return spark.createDataFrame([(*r, "own", "own", 1) for r in rows], schema).repartition(4)


def words(rng, n, of=400):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def edited(rng, tokens, times):
    tokens = list(tokens)
    for _ in range(times):
        tokens[rng.randrange(len(tokens))] = f"e{rng.randrange(10_000)}"
    return tokens


def near_copies(seed=4):
    rng = random.Random(seed)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "Only Three words"), (904, "only three WORDS"), (905, "other three words")]
    passage = words(rng, 40)
    for g in range(6):
        base = words(rng, rng.randrange(20, 160))
        for _ in range(rng.randrange(1, 9)):
            rows.append((rng.randrange(10_000) + 1000, " ".join(edited(rng, base, rng.randrange(0, 5)))))
    for i in range(30):
        rows.append((i, " ".join(words(rng, 60) + passage + words(rng, 60))))
    rows += [(50 + i, rows[-1][1]) for i in range(12)]
    rows += [(70, " ".join(words(rng, 20_000, 50_000))), (None, rows[-1][1]), rows[-1]]
    return rows


def gram_sets(rows):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def test_ngram_join_against_brute_force(spark):
    rows = near_copies()
    sets = gram_sets(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    want = sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)
    docs = documents(spark, rows)
    got = ngram_join.components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == want
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in want} | {None}


def test_ngram_join_sql(spark):
    name = "op1_ngram_jaccard_join"
    df = entry.queries()[name](spark, SF_DIR)
    cur = duck(SF_DIR).execute(entry.oracle_sql()[name])
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows([d[0] for d in cur.description], cur.fetchall())


def test_ngram_join_empty(spark):
    assert ngram_join.components(documents(spark, [(1, "a")]).where("false")).count() == 0


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(50)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(40)]
    least = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in out} == {n: least[n] for n in linked} and len(out) == len(linked)


def brute_removals(rows, length=suffix_dedup.LENGTH):
    raw = [(t or "").encode() for _, t in rows]
    times = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            times[s] = times.get(s, 0) + 1
    out = []
    for (doc_id, _), b in zip(rows, raw):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i : i + length] = True
        starts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((doc_id, len(b), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_passages(seed=8):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [text(rng.choice([390, 400, 401, 450, 700, 1500])) for _ in range(8)]
    rows = [(900, None), (901, ""), (902, "short"), (903, "=" * 1200), (904, "ab" * 500), (905, "x" * 399), (906, "x" * 399)]
    for i in range(25):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 40)
            parts += [text(rng.randrange(0, 300)), p[a:] if rng.random() < 0.5 else p[: len(p) - a]]
        rows.append((i, "".join(parts)))
    base = text(2_500)
    rows += [(100 + i, base[:1200] + str(i) + base[1200:]) for i in range(4)]
    return rows + [(200, rows[8][1]), (None, rows[9][1]), rows[10]]


def test_suffix_dedup_against_brute_force(spark):
    rows = repeated_passages()
    got = suffix_dedup.document_removals(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_removals(rows), key=str)
    assert suffix_dedup.document_removals(documents(spark, rows).where("false")).count() == 0


def test_suffix_slices_agree():
    raw = np.frombuffer(random.Random(1).randbytes(9_000), np.uint8)
    places = suffix_dedup.anchors(raw)
    hashes = suffix_dedup.phrases(raw, places, suffix_dedup.Hasher())
    before = suffix_dedup.SLICE
    try:
        suffix_dedup.SLICE = 1_000
        assert (suffix_dedup.anchors(raw) == places).all()
        assert (suffix_dedup.phrases(raw, places, suffix_dedup.Hasher()) == hashes).all()
    finally:
        suffix_dedup.SLICE = before
    assert np.diff(places).max() <= suffix_dedup.WINDOW


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def changed(rng, text, most, letters="abc"):
    text = list(text)
    for _ in range(rng.randrange(most + 1)):
        at, how = rng.randrange(len(text) + 1), rng.random()
        if how < 0.35 and text:
            text.pop(min(at, len(text) - 1))
        elif how < 0.65:
            text.insert(at, rng.choice(letters))
        elif text:
            text[min(at, len(text) - 1)] = rng.choice(letters)
    return "".join(text)


def test_within_edits():
    rng = random.Random(6)
    for _ in range(5_000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(10)))
        b = changed(rng, a, 4)
        for k in range(4):
            assert line_dedup.within(a, b, k) == (edits(a, b) <= k)


@pytest.mark.parametrize("long_list", [32, 2])
def test_line_dedup_against_brute_force(spark, monkeypatch, long_list):
    monkeypatch.setattr(line_dedup, "LONG_LIST", long_list)
    rng = random.Random(7)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randrange(38, 56))) for _ in range(30)]
    rows = [(i, "\n".join(changed(rng, rng.choice(base), 4) for _ in range(rng.randrange(1, 5)))) for i in range(70)]
    rows += [(None, base[0]), (200, None), (201, ""), (202, "short\nshort"), rows[3]]
    lines = sorted({(line_dedup.NO_ID if d is None else d, n, x) for d, t in rows for n, x in enumerate((t or "").split("\n")) if len(x) >= 40})
    first = {}
    for d, n, x in lines:
        first.setdefault(x, (d, n))
    near = {x for x in first if any(first[y] < first[x] and abs(len(x) - len(y)) <= 2 and edits(x, y) <= 2 for y in first if x != y)}
    want = [(d, n) for d, n, x in lines if x in near or (d, n) > first[x]]
    got = line_dedup.repeated_lines(documents(spark, rows))
    assert sorted((r["doc"], r["n"]) for r in got.collect()) == want


def test_short_lines_against_brute_force(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcd") for _ in range(n)) for n in (3, 12, 18, 19, 20, 21, 24, 30, 38, 39, 40, 41, 44) * 2]
    rows = [(i, "\n".join(changed(rng, rng.choice(base), 2) for _ in range(rng.randrange(1, 5)))) for i in range(90)]
    rows += [(200, "---\n\n---\n \n==="), (201, "---\nagain\nagain"), (202, "again")]
    lines = sorted({(d, n, x) for d, t in rows for n, x in enumerate(t.split("\n")) if any(c.isalnum() for c in x)})
    first = {}
    for d, n, x in lines:
        first.setdefault(x, (d, n))
    most = lambda n: 2 if n >= 40 else 1 if n >= 20 else 0
    near = {x for x in first if any(first[y] < first[x] and edits(x, y) <= most(min(len(x), len(y))) for y in first if x != y)}
    want = {}
    for d, n, x in lines:
        if x in near or (d, n) > first[x]:
            want.setdefault(d, []).append(n)
    got = {r["doc"]: r["repeats"] for r in line_dedup.marked(documents(spark, rows)).collect()}
    assert got == want


def test_deduplicated_documents(spark):
    shared = "this line is long enough to be looked at and is in many documents"
    own = "\n".join(f"{c * 3} own line of a document that is long enough to be looked at {c * 9}" for c in "abc")
    rows = [(1, shared), (2, f"{own}\n{shared}"), (3, f"{shared}!\n{own.replace('own', 'new and different')}"), (4, f"{own}\n{shared}"), (5, None)]
    docs = documents(spark, rows)
    out = line_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    # 2 and 3 lose the shared line; 4 repeats 2 as a whole and is left to document deduplication.
    assert text == {1: shared, 2: own, 3: own.replace("own", "new and different"), 4: rows[3][1], 5: None}
    assert line_dedup.deduplicated(docs.where("false")).count() == 0


def test_repeats_of_several_documents_are_no_copy(spark):
    line = lambda i: f"{'abcdefgh'[i] * 5} line number {i} that is long enough to be looked at {'abcdefgh'[i] * 11}"
    own = line(6)
    rows = [(i, line(i)) for i in range(3)]
    # 3 repeats three documents, 4 itself; 5 repeats the lines that 3 has first no more than others.
    rows += [(3, "\n".join([line(0), line(1), line(2), own])), (4, "\n".join([line(7)] * 4))]
    rows += [(5, rows[3][1])]
    docs = documents(spark, rows)
    text = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs).collect()}
    assert text == {**{i: line(i) for i in range(3)}, 3: own, 4: line(7)}
    whole = documents(spark, rows[:1] + [(8, "\n".join([own, line(3), line(4)])), (9, "\n".join([own, line(3) + "!", line(4), line(5)]))])
    text = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(whole).collect()}
    assert text[9].startswith(own)


def test_pipeline_keeps_one_of_each_group_of_its_input(spark):
    """Copies with edited words share some long lines only; a repeated line may not part them from their original."""
    rng = random.Random(12)
    shared = " ".join(words(rng, 60))
    rows = [(0, shared)]
    for g in range(1, 4):
        lines = [words(rng, 60, 5_000) for _ in range(4)]
        rows.append((10 * g, "\n".join([*map(" ".join, lines), shared])))
        for c in range(1, 3):
            rows.append((10 * g + c, "\n".join([*(" ".join(edited(rng, x, 1)) for x in lines[:3]), " ".join(lines[3]), shared])))
    sets = gram_sets(rows)
    near = lambda i, j: 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    assert all(near(i, i + c) for i in (1, 4, 7) for c in (1, 2))
    docs = documents(spark, rows)
    for stage in (corpus_pipeline.line_dedup, corpus_pipeline.ngram_jaccard_join):
        docs = stage(spark, docs, SF_DIR)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    # One of each group, without the line that another document has first.
    assert text == {0: shared, **{10 * g: rows[3 * g - 2][1].rsplit("\n", 1)[0] for g in range(1, 4)}}


def exact_neighbours(ids, x, queries, nearest):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[ids == ids[q]] = np.inf
        order = [i for i in np.lexsort((ids, d)) if d[i] < np.inf][:nearest]
        out[int(ids[q])] = [(int(ids[i]), d[i]) for i in order]
    return out


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    n, dim = 3_000, 24
    centres = rng.standard_normal((40, dim)) * 3
    x = centres[rng.integers(0, 40, n)] + rng.standard_normal((n, dim))
    x[200:230] = x[100]  # ties
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(5_000, None), (5_100, [0.0] * dim), (5_200, [float("nan")] * dim), (5_300, [1.0, None] + [1.0] * (dim - 2)), (5_400, [1.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(4)
    found = ann.nearest_neighbours(df, F.col("vec_id") % 100 == 0, part=700).collect()
    want = exact_neighbours(np.arange(n), x, range(0, n, 100), 10)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, near in got.items():
        assert near == sorted(near, key=lambda p: (p[1], p[0])) and len(near) == 10
        assert all(abs(np.sqrt(((x[i] - x[q]) ** 2).sum()) - d) < 1e-12 for i, d in near)


@pytest.mark.parametrize("dim", [24, 64, 384])
def test_scan_keeps_all_copies(dim):
    """Of 2,000 copies in one list the smallest ids are found, wherever they lie."""
    rng = np.random.default_rng(dim)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    x = rng.standard_normal((3_000, dim))
    x[:2_000] = x[0]
    ids = np.arange(3_000)
    order = rng.permutation(3_000)
    ids, x = ids[order], x[order]
    whole = x @ rotation
    rotated = [np.ascontiguousarray(whole[:, c : c + ann.COLUMNS]) for c in range(0, dim, ann.COLUMNS)]
    for query in (0, 777, 1_999):
        near, score = ann.scan_list(ids, x, rotated, query, x[ids == query][0], rotation)
        assert near.tolist() == [i for i in range(11) if i != query][:10]
        assert not score.any()


def test_nearest_neighbours_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 2.0])], "vec_id long, embedding array<float>")
    rows = ann.nearest_neighbours(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 0.0), (0, 2, 2, 1.0)]
    assert ann.nearest_neighbours(df.where("false"), F.col("vec_id") == 0).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage keeps clean documents and does its own work."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == columns
        path = str(tmp_path / name)
        after.write.parquet(path)
        after = spark.read.parquet(path)
        old, new = ({r["doc_id"]: r["text"] for r in df.collect()} for df in (before, after))
        assert set(new) <= set(old)
        if name == "quality_rules":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()
            lost = [r["doc_id"] for r in labels if r["doc_id"] in old and r["doc_id"] not in new]
            assert all(len(old[d].split()) < 20 for d in lost)
        if name == "ngram_jaccard_join":
            rows = sorted(old.items())
            sets = gram_sets(rows)
            kept = [i for i, (d, _) in enumerate(rows) if d in new]
            assert not [1 for i in kept for j in kept if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        before = after
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    want = {d: len((t or "").encode().split()) + 1 for d, t in new.items()}
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
    assert got == want


def test_a_text_is_hashed_before_its_lines_are_apart(spark):
    docs = spark.createDataFrame([(1, "one line\nand another line")], "doc_id long, text string")
    rows = line_dedup.line_rows(docs)
    assert rows.count() == 2
    # Top first: the hash of the text lies below the step that takes its lines apart.
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate") < plan.rindex("AS tie")


def test_letters_of_many_lines_at_once():
    bodies = ["a", "aab" * 9, "日本語 text é" * 3, "\U0001f600 x\x00"]
    want = [sum(1 << c for c in range(32) if sum(ord(x) & 31 == c for x in body) % 2) for body in bodies]
    assert [int(v) & 0xFFFFFFFF for v in line_dedup.letters_of(bodies)] == want


def test_signs_lose_no_near_line_and_part_template_lines():
    """Lines within ``k`` edits pass; lines of one template whose numbers differ mostly do not."""
    rng = random.Random(41)
    unsigned = lambda bodies: [int(v) & (1 << 64) - 1 for v in line_dedup.signs_of(bodies)]
    for k in (1, 2, 3):
        for _ in range(300):
            a = "".join(rng.choice("abcd 123é日") for _ in range(rng.randrange(20, 80)))
            b = changed(rng, a, k, "abcd 123é日")
            if a and b:
                x, y = unsigned([a, b])
                assert line_dedup.may_be_near(x ^ y, k)
    signs = unsigned([f"line {i} of a long text, which differs in its number {i * 7919}" for i in range(20_000, 20_600)])
    passed = sum(line_dedup.may_be_near(x ^ y, 2) for n, x in enumerate(signs) for y in signs[:n])
    assert passed < 600 * 599 // 2 // 20


def test_tasks_post_and_cut_in_small_pieces():
    """What a task holds at once does not grow with the batch it is given."""
    rng = random.Random(5)
    bodies = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(9_000)]
    ids = pa.array(range(len(bodies)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, pa.array(bodies)], names=["doc", "n", "line", "body"])
    out = list(line_dedup._poster(2, 20)([batch]))
    assert len(out) > 4 and {x for b in out for x in b.column("line").to_pylist()} == set(range(len(bodies)))
    texts = pa.RecordBatch.from_arrays([ids, pa.array(bodies)], names=["doc_id", "text"])
    rows = [b for b in ngram_join._first_cut(5, 75, 40)([texts]) if b.num_rows and b.column("hits")[0].as_py() < -1]
    assert max(b.num_rows for b in rows) <= ngram_join.TAKEN and sum(b.num_rows for b in rows) == len(bodies)
