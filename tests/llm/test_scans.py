"""Decontamination, language, license, quality, mixing, archives and quotes on small cases."""

import gzip
import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillstat.llm import decontaminate, host_rules, language, licenses, mixing, quotes, warc
from quillstat.llm.catalogue import QUERIES
from quillstat.llm.common import new_folder

from test_joins import A_Z, LAST, id_of, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_leaks(spark, messy, nothing, monkeypatch):
    texts = {r.doc_id: r.text for r in messy.collect()}
    items = [(1, "  ".join(texts[0].split()[3:17])), (2, "one"), (3, None), (4, ".;"), (5, texts[6].upper()), (2, "three"), (None, "MIT license")]
    items = spark.createDataFrame([(*i, "extra") for i in items], "item_id long, text string, kind string")

    def words(text):
        return WORD.findall((text or "").translate(A_Z))

    windows = {}
    for r in items.collect():
        w = words(r.text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add("" if r.item_id is None else str(r.item_id))
    want = []
    for r in messy.collect():
        w, hit, own = words(r.text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    own |= windows[tuple(w[k:k + n])]
        want.append((id_of(r.doc_id), len(w), len(hit), ",".join(sorted(own))))
    for size in (decontaminate.ITEM_BYTES, 100):  # one automaton, several
        monkeypatch.setattr(decontaminate, "ITEM_BYTES", size)
        out = decontaminate.find_leaks(messy, items).withColumn("hit", decontaminate.hit_words(F.col("leak_spans"))).collect()
        assert Counter(want) == Counter((id_of(r.doc_id), r.leak_words, r.hit, ",".join(sorted({s.item_id for s in r.leak_spans}))) for r in out)
        for r in out:
            for s in r.leak_spans:
                assert WORD.findall(r.text[s.begin:s.end].translate(A_Z)) == words(r.text)[s.first_word:s.last_word + 1]
    assert decontaminate.find_leaks(nothing, items).count() == 0
    assert decontaminate.find_leaks(messy, items.limit(0)).filter(F.size("leak_spans") > 0).count() == 0
    with pytest.raises(ValueError):
        decontaminate.find_leaks(messy, items, spans="gid")


def test_numbers_of_part_files():
    assert [warc.shard_of(f"file:/x/part-1/kind=warc/part-{n}-abc-c000.warc") for n in ("00007", "99999", "123456")] == [7, 99_999, 123_456]


def spoken(texts, labelled):
    """Scores of whole texts with plain dictionaries, one word after the other."""
    shares, langs = {}, sorted({lang for lang, _ in labelled})
    for lang, text in labelled:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = f" {word} "
            for token in [(0, word), *((n, padded[k:k + n]) for n in range(1, 5) for k in range(len(padded) - n + 1))]:
                shares.setdefault(token, Counter())[lang] += 1
    totals = Counter()
    for (size, _), own in shares.items():
        for lang, n in own.items():
            totals[lang, size] += n
    logs = {}
    for (size, token), own in shares.items():
        row = [math.log(max(language.FLOOR, own[lang] / totals[lang, size] if totals[lang, size] else 0)) for lang in langs]
        logs[size, token] = [x - sum(row) / len(row) for x in row]
    for text in texts:
        found = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not any(c.isalpha() for w in found for c in w):
            yield language.UNKNOWN, 0.0
            continue
        total = [0.0] * len(langs)
        for word in found:
            rows = [logs[0, word]] if (0, word) in logs else []
            if not rows:
                padded = f" {word} "
                for k in range(len(padded)):
                    fits = [logs[n, padded[k:k + n]] for n in (4, 3, 2, 1) if (n, padded[k:k + n]) in logs and k + n <= len(padded)]
                    rows += fits[:1]
            for k in range(len(langs)):
                total[k] += sum(r[k] for r in rows) / max(1, len(rows))
        best = max(range(len(langs)), key=lambda k: (round(total[k], 9), -k))
        yield langs[best], 1 / sum(math.exp(x - total[best]) for x in total)


def test_language_against_a_plain_scorer(spark, messy, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = docs.filter(~language.held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    labelled = [(r.lang, r.text) for r in seen.collect()]
    # A word of the last rank is known too: no count cuts the sample's vocabulary.
    rare = " ".join("q" + "".join(chr(97 + (k // 26 ** d) % 26) for d in range(4)) for k in range(40_000))
    model = language.fit(spark.createDataFrame([*labelled, ("fr", rare)], "lang string, text string"))
    assert all(w in model.places[0] for w in rare.split())
    texts = [r.text for r in docs.union(docs.limit(3)).collect()] + [r.text for r in messy.collect()] + [rare[:60], "ﬀ Ωmega", "x" * 3000]
    want = list(spoken(texts, [*labelled, ("fr", rare)]))
    for room in (language.CACHE, 5):
        monkeypatch.setattr(language, "CACHE", room)
        got = list(model.predict(texts))
        assert [g[0] for g in got] == [lang for lang, _ in want]
        assert [g[1] for g in got] == pytest.approx([score for _, score in want], abs=1e-6)
        assert all(0 <= g[2] <= 1 for g in got) and got[texts.index(rare[:60])][2] > 0.9


def test_pipeline_keeps_columns_and_drops_unlearnt_languages(spark, tmp_path):
    """Columns named like helpers come through; a long text of words no language has goes, short ones stay."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = {c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in (
        "_text", "_lang", "_score", "_known", "_spans", "_words", "_n", "_lost", "row", "th", "first")}
    foreign = " ".join(f"vb{chr(97 + k % 26)}kk{chr(97 + k // 26)}zg" for k in range(300))
    odd = spark.createDataFrame([(-1, foreign), (-2, "vbakkazg")], "doc_id long, text string")
    given = docs.withColumns(extra).unionByName(odd, allowMissingColumns=True)
    kept = {r.doc_id: r for r in corpus_pipeline.identified(spark, given, folder).collect()}
    assert -1 not in kept and -2 in kept and set(kept) >= {r.doc_id for r in docs.filter("length(text) > 40").collect()}
    for stage in (corpus_pipeline.without_repeated_lines, corpus_pipeline.one_of_each_class, corpus_pipeline.without_leaks):
        out = stage(spark, docs.withColumns(extra), folder)
        assert out.columns == [*docs.columns, *extra]
        assert all(r[c] == f"{c} of {r.doc_id}" for r in out.collect() for c in extra)


def test_language(spark, messy, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))).select("lang", "text"))
    out = language.identify(docs, model).filter(language.held_out(F.col("doc_id")))
    assert out.filter("lang <> lang_pred").count() <= 0.05 * out.count() and out.count() > 30
    unseen = spark.createDataFrame([("thwhingtion", "en"), ("eauxmentè", "fr"), (None, None), ("12 !?", None), ("", None), ("½ ²", None)], "text string, want string")
    found = {r.text: r for r in language.identify(unseen, model).collect()}
    assert found["thwhingtion"].lang_pred == "en" and found["eauxmentè"].lang_pred == "fr"
    assert all(found[t].lang_pred == "und" and found[t].lang_score == 0 for t in (None, "12 !?", "", "½ ²"))
    assert all(0 <= r.lang_score <= 1 for r in language.identify(messy, model).collect())
    assert language.identify(nothing, language.fit(nothing)).count() == 0
    assert {r.lang_pred for r in language.identify(messy, language.fit(nothing)).collect()} == {"und"}


def test_licenses(spark, messy, nothing):
    want = []
    for r in messy.collect():
        w, at, labels = WORD.findall((r.text or "").translate(A_Z)), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            for k in range(len(w)):
                if w[k:k + len(p)] == p:
                    at.append(k)
                    labels.add(label)
        want.append((id_of(r.doc_id), len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    found = licenses.scan(messy).collect()
    assert Counter(want) == Counter((id_of(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found)
    more = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0."), (2, "some license"), (3, "This is licensed under the GNU GENERAL-public license, ok"), (4, "by cc 4 nc")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(more).collect()}
    assert got[1].labels == "cc-by-nc" and got[1].score == 1 and got[2].labels == got[4].labels == "" and got[3].base_labels == "gpl"
    assert 0.5 <= got[3].score < 1 and licenses.scan(nothing).count() == 0


def test_several_licenses_in_a_file(spark):
    bodies = [(label, text) for label, text, _ in licenses.TEMPLATES]
    files = [[x] for x in bodies] + [[x, y] for x in bodies for y in bodies if x != y] + [bodies, bodies[::-1]]
    rows = [(k, ".\nAnd, of the work: ".join(text for _, text in file)) for k, file in enumerate(files)]
    # the end of one notice at the start of a text, before another whole one
    rows.append((len(files), "Source and binary forms, or Mozilla Public License v 2 0. Licensed under CC BY-SA 4.0"))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, file in enumerate(files):
        assert {label for label, _ in file} <= set(got[k].labels.split(",")), file
    texts = [WORD.findall(text.translate(A_Z)) for _, text in rows]
    counts = Counter(w for words in texts for w in set(words))
    idf = {w: round(math.log((1 + len(rows)) / (1 + n)) + 1, 6) for w, n in counts.items()}
    for k, words in enumerate(texts):
        best, labels = 0, set(got[k].base_labels.split(",")) - {""}
        for label, body, key in licenses.TEMPLATES:
            body = body.split()
            for start in range(1 - len(body), len(words)):
                if f" {key} " in f" {' '.join(words[max(0, start):start + len(body)])} ":
                    share = sum(idf[w] for i, w in enumerate(body, start) if 0 <= i < len(words) and words[i] == w) / sum(idf[w] for w in body)
                    best = max(best, share)
                    labels |= {label} if round(share, 6) >= licenses.SHARE else set()
        assert got[k].labels == ",".join(sorted(labels)) and abs(got[k].score - best) < 2e-6


def test_licenses_by_templates_of_ones_own(spark):
    """No fixed pre-test: starts come from the words of the templates given."""
    body = "this software is provided as is without any express or implied warranty"
    own = (("zlib", body, "without any express or implied warranty"), *licenses.TEMPLATES)
    rows = [(1, body), (2, f"Note. {body.upper()}, and under CC BY 4.0"), (3, "implied warranty without any express"), (4, "mit " + body[5:]),
            (5, "without any express or implied warranty")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=own).collect()}
    # the key phrase alone weighs less than a half, since three files have them
    assert {k: r.labels for k, r in got.items()} == {1: "zlib", 2: "zlib", 3: "", 4: "zlib", 5: ""} | {2: got[2].labels}
    assert "zlib" in got[2].labels.split(",") and got[1].score == got[2].score == 1 and got[3].score == 0
    # less than a label needs is still a score
    few = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(1, "apache license"), (2, "other")], "doc_id long, text string")).collect()}
    assert 0 < few[1].score < licenses.SHARE and few[1].labels == "apache" and few[2].score == 0


def test_quality(spark, messy, nothing):
    rows = messy.collect()
    want = []
    for r in rows:
        text = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        rep = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((id_of(r.doc_id), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                     len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    found = host_rules.quality_verdicts(messy).collect()
    assert Counter(want) == Counter((id_of(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert not any(r.kept and r.base_failed for r in found)
    assert host_rules.quality_verdicts(nothing).count() == 0
    hosts = [("bad", True)] * 40 + [("good", False)] * 60 + [("new", True)] + [(None, False)] * 30
    out = {r["host"]: r for r in host_rules.host_verdicts(spark.createDataFrame(hosts, "h string, f boolean"), host="h", failed="f").collect()}
    assert out["bad"].host_failed and not out["good"].host_failed and not out[None].host_failed
    assert out["new"].host_rate < out["bad"].host_rate < 1


def test_mix(spark, messy, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)
    sums, targets = Counter(), {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        sums[r.source] += r.taken
        targets[r.source] = r.target
    assert abs(sum(targets.values()) - 1.5 * sum(r.size for r in out)) < 1e-3
    assert all(abs(sums[s] - t) <= 0.03 * t + 5 for s, t in targets.items())
    found = mixing.mix(messy).collect()
    assert len(found) == messy.count() and all(0 <= r.taken <= 2 * r.size and 0 <= r.target <= 2 * r.source_size for r in found)
    assert mixing.mix(nothing).count() == 0


def test_targets(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 10), ("d", 0), (None, 400)]
    out = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    # 2265 words: a stops at 200, c at 20, d at 0; b and null share 2045 by 1 and 1, so null stops at 800
    assert out == {"a": 200, "c": 20, "d": 0, None: 800, "b": 1245}


def test_flight_keeps_totals():
    import random
    draw = random.Random(1)
    sizes = [draw.randint(1, 400) for _ in range(500)]
    chances = [draw.random() for _ in sizes]
    out = mixing.flight(chances, sizes, random.Random(2))
    assert sum(0 < p < 1 for p in out) <= 2 and all(0 <= p <= 1 for p in out)
    assert abs(sum(out) - sum(chances)) < 1e-4
    assert abs(sum(p * s for p, s in zip(out, sizes)) - sum(p * s for p, s in zip(chances, sizes))) < 0.1


def test_archives(spark, monkeypatch):
    big = "w" * (17 << 20)
    pages = [(1, "http://a/b c\r\nX: y", "<p>é</p>", 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "<p>é</p>", 1), (None, "u", "<p>é</p>", 1),
             (5, "u", "a\r\n\r\nWARC/1.1\r\n\r\n", 1), (6, "u", big, 1), (7, "u", "z", 1), (7, "u", "z", 1), (None, "u", "nul\0l", 1)]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string, kind int")
    first, second, third = (new_folder(spark, n) for n in ("w", "m", "n"))
    warc.write_archives(pages.coalesce(2), first)
    warc.normalise(spark, first, second)
    index, records = warc.read_index(spark, second).collect(), warc.read_records(spark, second).collect()
    assert len(index) == len(records) == 10 and {(r.shard, r.offset) for r in index} == {(r.shard, r.offset) for r in records}
    by = {r.page_id: r for r in records if r.page_id is not None}
    assert by[1].type == "revisit" and by[1].refers_to == 4 and by[1].digest == by[4].digest and by[1].payload_bytes == 9
    assert by[2].type == "revisit" and by[2].refers_to == 3 and by[3].payload_bytes == 0
    assert bytes(by[5].payload) == b"a\r\n\r\nWARC/1.1\r\n\r\n" and bytes(by[6].payload) == big.encode()
    assert sorted(r.type for r in records if r.page_id == 7) == ["response", "response"]
    assert sorted((r.type, r.refers_to or 0) for r in records if r.page_id is None) == [("response", 0), ("revisit", 4)]
    # files are plain gzip of several members; the index finds each alone
    files = {warc.shard_of(p): bytes(c) for p, c in spark.read.format("binaryFile").load(f"{second}/kind=warc").select("path", "content").collect()}
    for r in index:
        text = gzip.decompress(files[r.shard][r.offset:r.offset + r.length])
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
    assert sum(gzip.decompress(f).count(b"WARC-Type: ") for f in files.values()) == 10
    warc.normalise(spark, f"{second}/kind=warc", third)  # its own output, in members
    key = lambda r: (str(r.page_id), r.type, r.digest, r.payload_bytes)
    assert sorted(map(key, warc.read_records(spark, third, payloads=False).collect())) == sorted(map(key, records))
    empty = new_folder(spark, "e")
    warc.write_archives(pages.limit(0), empty)
    with pytest.raises(Exception):
        list(warc.parsed(warc.inflated(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nx"))))
    with pytest.raises(Exception):
        list(warc.inflated(gzip.compress(b"x" * 5000)[:-9]))


def test_quotes(spark):
    rows = [(1, 0, "u", "Hello  World\nsecond"), (1, 1, "a", "> hello world\nhi"), (1, 2, "u", ">> hello world\n> HI\nyes"), (1, 3, "u", "alone"),
            (1, 4, "a", "> nobody said this\nok"), (1, 5, "a", "> yes\n>\n> ok"), (1, 6, "u", None), (1, 7, "u", ""), (2, 1, "u", "> hello world"),
            (None, 1, "u", "> alone"), (3, None, "u", "> alone"), (1, 3, "u", "alone"), (4, 0, "u", "a > b"), (1, 8, "u", "> second")]
    rows = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, th string")
    out = quotes.link_quotes(rows).collect()
    assert len(out) == 14
    by = {(r.conv_id, r.turn): r for r in out}
    got = {t: (r.parent_turn, r.root_turn, r.depth, r.n_quotes, r.n_linked, r.own_text) for (c, t), r in by.items() if c == 1}
    assert got[1] == (0, 0, 1, 1, 1, "hi") and got[2] == (1, 0, 2, 2, 2, "yes") and got[3] == (None, 3, 0, 0, 0, "alone")
    assert got[4] == (None, 4, 0, 1, 0, "ok") and got[5] == (None, 5, 0, 1, 0, "") and got[6][5] is None and got[7][5] == "" and got[8][0] == 0
    assert by[2, 1].parent_turn is None and by[4, 0].own_text == "a > b" and by[None, 1].n_linked == 0
    assert quotes.link_quotes(rows.limit(0)).count() == 0


def test_quotes_of_several_lines(spark):
    rows = [(1, 0, "One\n\ntwo  words\nthree\nfour"), (1, 1, "> TWO words\n> three\nsure"), (1, 2, "> sure\nthen"), (1, 3, "> one\n> three\nskips a line"),
            (1, 4, "> three\n> two words\nturned round"), (1, 5, "one\ntwo words\nthree\nfour\nfive"), (1, 6, "> three\n> four\n> five\nlater"),
            (1, 7, "> One\n>\n> two words\nblank between"), (1, 8, ">> two words\n>> three\n> sure\nboth"), (1, 9, "> four\n> five\n> six\nnobody"),
            (1, 10, "x\n> other\ny\nz"), (1, 11, "> x\n> y\nown lines"), (1, 12, "three\nfour"), (1, 13, "> three\n> four\nthe whole of 12"),
            (2, 1, "> two words\n> three\nnot here"), (3, 0, "> a\n> b\nbefore"), (3, 1, "a\nb\nc"), (None, 0, "a\nb\nc"), (None, 1, "> a\n> b")]
    rows = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.parent_turn, r.root_turn, r.depth) for r in quotes.link_quotes(rows).collect()}
    assert got[1, 1] == (1, 1, 0, 0, 1) and got[1, 2] == (1, 1, 1, 0, 2)
    assert got[1, 3] == (1, 0, None, 3, 0) and got[1, 4] == (1, 0, None, 4, 0)
    assert got[1, 6] == (1, 1, 5, 5, 1) and got[1, 7] == (1, 1, 0, 0, 1) and got[1, 8] == (2, 2, 1, 0, 2)
    assert got[1, 9] == (1, 0, None, 9, 0) and got[1, 11] == (1, 1, 10, 10, 1) and got[1, 13] == (1, 1, 12, 12, 1)
    assert got[2, 1][1] == got[3, 0][1] == got[None, 1][1] == 0


def test_a_common_line_has_one_origin(spark):
    rows = [(1, t, "u", "same\n> same") for t in range(30)] + [(1, None, "u", "same"), (2, 5, "u", "same")]
    rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((r.conv_id, r.origin) for r in quotes.units(rows).collect()) == [(1, 0), (2, 5)]
    got = {(r.conv_id, r.turn): r.parent_turn for r in quotes.link_quotes(rows).collect()}
    assert got[1, 0] is None and all(got[1, t] == 0 for t in range(1, 30))


def test_queries_and_stages(spark):
    folder = "/root/testdata/sf0.001"
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 11))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == docs.count() > 0
    assert sorted(map(str, last.collect())) == sorted(map(str, corpus_pipeline.run(spark, folder).collect()))


def test_stages_on_messy_rows(spark, messy, nothing):
    folder = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, messy, folder).count()
        assert stage(spark, nothing, folder).count() == 0
    near = corpus_pipeline.one_of_each_class(spark, messy, folder)
    rows = rows_of(near)
    assert near.columns == messy.columns and len([r for r in rows if r.doc_id == 3]) <= 1
    assert {0, 3, 36, 37} <= {r.doc_id for r in rows} and 1 not in {r.doc_id for r in rows}
    assert all(id_of(r.doc_id) < LAST or r.text is None for r in rows)


def test_digest():
    assert warc.digest_of(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert hashlib.sha1(b"").hexdigest().startswith("da39")
