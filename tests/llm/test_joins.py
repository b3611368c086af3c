"""Brute-force versions of the operators on sets, lines and substrings."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillstat.llm import deal, jaccard_join, line_dedup, shingles, suffix_dedup
from quillstat.llm.components import components

LAST = 1 << 63
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_Z))


def shingle_set(found, short):
    if len(found) < 5:
        return {tuple(found)} if found and short else set()
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)}


def similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def id_of(x):
    return LAST if x is None else x


def rows_of(df):
    """Rows in the library's order of ids; equal ids by the hash of the text."""
    return df.withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_last(), "h").collect()


def test_classes(spark, messy, nothing):
    rows = rows_of(messy)
    sets = [shingle_set(words(r.text), True) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    least = defaultdict(lambda: LAST)
    for i, r in enumerate(rows):
        least[label[i]] = min(least[label[i]], id_of(r.doc_id))
    want = Counter((id_of(r.doc_id), len(s), least[label[i]]) for i, (r, s) in enumerate(zip(rows, sets)))
    found = jaccard_join.similar_classes(messy).collect()
    assert Counter((id_of(r.doc_id), r.n_shingles, id_of(r.component_id)) for r in found) == want
    firsts = {(r.component_id, r.doc_id, r.th) for r in found if r["first"] and r.n_shingles}
    assert len(firsts) == len({r.component_id for r in found if r.n_shingles})
    assert jaccard_join.similar_classes(nothing).count() == 0


def test_tree_equals_all_pairs_and_blocks():
    draw = np.random.default_rng(3)
    sets = []
    for _ in range(25):
        base = np.unique(draw.integers(1, 10**6, 40).astype(np.uint64))
        for drop in range(4):
            sets.append(np.unique(np.append(np.delete(base, draw.integers(0, len(base), 2 * drop)), draw.integers(1, 10**6, drop).astype(np.uint64))))
    tree = jaccard_join.PrefixTree(sets, 75)
    found = tree.link()
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if similar(set(sets[i].tolist()), set(sets[j].tolist())):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    assert len(set(zip(found, label))) == len(set(found)) == len(set(label))


def test_classes_in_block_pairs(monkeypatch, messy):
    want = sorted(map(str, jaccard_join.similar_classes(messy).collect()))
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 60)
    assert sorted(map(str, jaccard_join.similar_classes(messy).collect())) == want


def kept_lines(rows):
    seen, out = [], []
    for r in rows:
        kept = []
        for line in [] if r.text is None else r.text.split("\n"):
            own = shingle_set(words(line), True)
            if not any(similar(own, s) for s in seen):
                kept.append(line)
            if own:
                seen.append(own)
        out.append((id_of(r.doc_id), None if r.text is None else "\n".join(kept), r.source, r.gid, r.rest))
    return Counter(out)


def test_lines(spark, messy, nothing, monkeypatch):
    want = kept_lines(rows_of(messy))

    def found():
        out = line_dedup.dedup_lines(messy).collect()
        return Counter((id_of(r.doc_id), r.text, r["rest"].source, r["rest"].gid, r["rest"]["rest"]) for r in out)

    assert found() == want
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 2)
    assert found() == want
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_short_lines(spark, messy, tmp_path):
    extra = [(100, "Home | About\n\nby  Ann\nfirst long line of six words"), (101, "BY ann\nhome | about\nhome about"), (102, "home\t| ABOUT"),
             (103, "first long line of six words\nby ann lee fox gray\nby ann lee fox"), (104, "By Ann Lee Fox Gray\nby ann lee fox")]
    docs = messy.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    seen, want = [], []
    for r in rows_of(docs):
        lines, kept = [] if r.text is None else r.text.split("\n"), []
        for line in lines:
            own = shingle_set(words(line), True)
            if not any(similar(own, s) for s in seen):
                kept.append(line)
            if own:
                seen.append(own)
        want.append((id_of(r.doc_id), len(lines), len(lines) - len(kept), None if r.text is None else "\n".join(kept)))
    assert any(n == k == 1 for _, n, k, _ in want)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = line_dedup.op6(spark, str(tmp_path)).collect()
    assert Counter((id_of(r.doc_id), r.n_lines, r.n_removed, r.kept_sha256) for r in found) == Counter(
        (d, n, k, hashlib.sha256((t or "").encode()).hexdigest()) for d, n, k, t in want)
    stage = corpus_pipeline.without_repeated_lines(spark, docs, str(tmp_path)).collect()
    assert Counter((id_of(r.doc_id), r.text) for r in stage) == Counter(
        (d, t) for d, _, k, t in want if not k or words(t))


def test_repeats(spark, messy, nothing, monkeypatch):
    rows = rows_of(messy)
    first = {}
    for r in rows:
        b = (r.text or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i:i + 50], id_of(r.doc_id))
    want = []
    for r in rows:
        b = (r.text or "").encode()
        mark = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < id_of(r.doc_id):
                mark[i:i + 50] = b"\1" * 50
        kept = bytes(c for c, m in zip(b, mark) if not m)
        want.append((id_of(r.doc_id), len(b), sum(mark), [list(m.span()) for m in re.finditer(rb"\x01+", bytes(mark))],
                     kept, hashlib.sha256(kept).hexdigest()))
    for size in (suffix_dedup.BLOCK_BYTES, 2000):
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", size)
        found = suffix_dedup.remove_repeats(messy).collect()
        assert sorted(map(str, want)) == sorted(str((id_of(r.doc_id), r.n_bytes, r.n_removed, r.spans, bytes(r.kept), r.kept_sha256)) for r in found)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("length", [200, 300, 700])
def test_repeats_of_long_strings(spark, length):
    draw = np.random.default_rng(length)
    copied = "".join(chr(97 + k) for k in draw.integers(0, 26, 2700))
    noise = ["".join(chr(97 + k) for k in draw.integers(0, 26, 400)) for _ in range(4)]
    docs = spark.createDataFrame([(1, noise[0] + copied + noise[1]), (2, noise[2] + copied + noise[3]), (3, copied[:length - 1])], "doc_id long, text string")
    found = {r.doc_id: (r.n_removed, r.spans) for r in suffix_dedup.remove_repeats(docs, length=length).collect()}
    assert found == {1: (0, []), 2: (2700, [[400, 3100]]), 3: (0, [])}


def test_two_stage_order():
    draw = np.random.default_rng(5)
    parts = [draw.integers(1, 4, 60) for _ in range(40)] + [np.full(60, 3), np.full(60, 3), np.full(60, 1)]
    text = np.concatenate([np.append(p, 0) for p in parts]).astype(np.int16)
    wanted = np.zeros(len(text), bool)
    for k in range(len(parts)):
        wanted[61 * k:61 * k + 11] = True
    order, same = suffix_dedup.two_stage_order(text, wanted, 50)
    keys = [tuple(text[i:i + 50]) for i in order]
    assert sorted(order) == list(np.flatnonzero(wanted)) and keys == sorted(keys)
    assert [bool(x) for x in same] == [False] + [a == b for a, b in zip(keys, keys[1:])]


def test_steps_of_prints():
    for prints in ([], [0], [65535], [5, 5, 70000, 70000 + 65535, 16_000_000]):
        packed = deal._packed(np.array(prints, np.int64))
        assert deal._unpacked(packed).tolist() == prints


def test_shingles_equal_in_any_slice(monkeypatch):
    import pyarrow as pa
    texts = pa.array(["a b c d e f", None, "", "A B C D E F", "a b c", "x  a b c d e f"])
    whole = jaccard_join.document_sets(pa.table({"text": texts}), 5)
    monkeypatch.setattr(shingles, "SLICE", 4)
    cut = jaccard_join.document_sets(pa.table({"text": texts}), 5)
    assert all((a == b).all() for a, b in zip(whole, cut)) and np.diff(whole[1]).tolist() == [2, 0, 0, 2, 1, 3]


@pytest.mark.parametrize("edges", [[], [("a", "a"), (None, "b")], [(f"{i:03d}", f"{i + 1:03d}") for i in range(200)]])
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert {r.label for r in found} == ({"000"} if len(edges) == 200 else set()) and len(found) in (0, 201)


def test_sets_are_joined_once(spark, tmp_path, monkeypatch):
    import uuid

    from quillstat.llm import jaccard_join

    folder, join = str(tmp_path), jaccard_join.forest

    def noted(percent):
        of = join(percent)

        def noting(rows):
            with open(f"{folder}/{rows['task'][0].as_py().replace(' ', '-')}_{uuid.uuid4().hex}", "w"):
                return of(rows)
        return noting

    monkeypatch.setattr(jaccard_join, "forest", noted)
    words = [f"w{i}" for i in range(60)]
    texts = [(k, " ".join(words[:55] + [f"x{k}"])) for k in range(6)] + [(9, " ".join(f"y{i}" for i in range(30)))]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_classes(frame).collect()}
    assert got == {**{k: 0 for k in range(6)}, 9: 9}
    tasks = [f.name.split("_")[0] for f in tmp_path.iterdir()]
    assert tasks and len(tasks) == len(set(tasks))
