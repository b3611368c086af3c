"""Tokenizer alignment, URL filters and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.llm import alignment, spelling, url_filter

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- Alignment -----------------------------------------------------------------

def whole_alignment(text, tools):
    """Groups of a whole text, encoded at once; None where a tokenizer does not give it back."""
    if not text:
        return None
    a_tool, b_tool, a_bytes, b_bytes = tools
    a, b = a_tool.encode(" " + text, add_special_tokens=False).ids, b_tool.encode(text)
    left, right = [a_bytes[k] for k in a], [b_bytes[k] for k in b]
    raw = (" " + text).encode()
    if b"".join(left) != raw or b"".join(right) != raw:
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in left]).tolist(), np.cumsum([len(x) for x in right]).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = i, j
        while i < len(a) and ends_a[i] <= cut:
            i += 1
        while j < len(b) and ends_b[j] <= cut:
            j += 1
        groups.append((a[x:i], b[y:j]))
    return groups, len(a), len(b)


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    own = alignment.Vocabularies(*(alignment._read(p) for p in (alignment.A_FILE, alignment.B_FILE)))
    a = Tokenizer.from_file(alignment.A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.B_FILE), own.a_table.data, own.b_table.data


def aligned_by_hand(texts, tools):
    """Rows of the contract for a list of texts."""
    found = {t: whole_alignment(t, tools) for t in set(texts)}
    counts, best = Counter(), Counter()
    for t in texts:
        if found[t]:
            counts.update({(x, y) for ga, gb in found[t][0] for x in ga for y in gb})
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for t in texts:
        if not found[t]:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        groups, n_a, n_b = found[t]
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        shown = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(counts[k] == best[k[0]] for k in links),
                    sum(counts[k] for k in links), shown))
    return out


ODD = ["", " ", "   ", "\n", "a", "a ", " a", "a  b", "a\tb\t\tc", "a\n\nb\n", "x = 1;\r\n y\r", "▁", "a▁b", "<|endoftext|> <s></s> <0x41> <unk>",
       "naïve ﬁ é é \U0001f600\U0001f468‍\U0001f469", "a\u00a0b \u2002 c\u3000d", "\x00\x1c \x1f!\x85 ", "don't we'll I'M", "1234 5,6", "日本語 の 文",
       "a" * 5000, "é" * 3000, " " * 3000, "ab " * 4000]


def test_alignment_against_one_text_at_a_time(spark, tools, messy, monkeypatch):
    draw = random.Random(2)
    noise = ["".join(chr(draw.choice([draw.randrange(32, 592), draw.randrange(592, 55_295), draw.randrange(57_344, 131_071), 32, 10, 9, 0x2009]))
                     for _ in range(60)) for _ in range(300)]
    texts = ODD + noise + [r.text for r in messy.select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = aligned_by_hand(texts, tools)
    assert any(not row[0] for row, t in zip(want, texts) if t)
    got = {r.doc_id: r for r in alignment.align_documents(docs.repartition(4)).collect()}
    for k, row in enumerate(want):
        assert tuple(got[k][c] for c in alignment.COLUMNS) == row, texts[k][:50] if texts[k] else texts[k]


def test_slow_encoder_gives_the_same(monkeypatch):
    import json

    data = alignment._read(alignment.A_FILE)
    letters = alignment._byte_letters()
    fast, tokens = alignment._byte_level(data, letters)
    assert len(tokens) == 50_257 and fast.__self__.__class__.__name__ == "Encoding"
    about = json.loads(data)
    about["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [about["pre_tokenizer"]]}
    slow, same = alignment._byte_level(json.dumps(about).encode(), letters)
    assert same == tokens and not hasattr(slow, "__self__")
    for text in ODD:
        assert slow(" " + text) == fast(" " + text)


def test_alignment_keeps_rows_and_columns(spark, messy, nothing):
    got = alignment.align_documents(messy, groups_as=lambda g: F.sha2(g, 256))
    assert got.columns == [*messy.columns, *alignment.COLUMNS] and got.count() == messy.count()
    empty = got.filter("text is null").first()
    assert (empty.n_a, empty.count_sum, empty.groups) == (0, 0, hashlib.sha256(b"").hexdigest())
    assert alignment.align_documents(nothing).count() == 0
    only_empty = messy.filter("text is null or text = ''")
    assert alignment.align_documents(only_empty).agg(F.sum("n_links")).first()[0] == 0
    with pytest.raises(ValueError, match="n_a"):
        alignment.align_documents(messy.withColumn("n_a", F.lit(1)))


# ---- URL filters ---------------------------------------------------------------

def judged_by_hand(url, rules, hosts):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(A_Z), m[2]) if m else ("", "")

    def belongs(h):
        return host == h or host.endswith("." + h)

    fits = []
    for rule, action in rules:
        h, p = re.fullmatch(r"([^/]*)(.*)", rule, re.S).groups()
        if belongs(h.translate(A_Z)) and path.startswith(p):
            fits.append((len(rule), len(h), h.translate(A_Z) + p, action))
    if fits:
        best = max(fits)
        return host, path, best[2], "allow" if any(f[2] == best[2] and f[3] == "allow" for f in fits) else best[3]
    return host, path, None, "block" if any(belongs(h.translate(A_Z)) for h in hosts if h) else "allow"


URLS = [None, "", "no scheme.com/", "http://", "https://com/", "http://com", "http://A.Example.COM/en/x?y#z", "http://www.example.com/en/",
        "http://x.www.example.com/en/1", "http://example.com/e", "http://notexample.com/en/", "http://a.net/es/", "http://net/fr/q", "http://a.net?/es/",
        "http://a.net#/es/", "http://a..com/", "http://com./x", "ftp://u:p@h.net:80/fr/", "http://q://r.com/x", "http://bad.org/", "http://w.bad.org",
        "http://é.com/ü", "x://a.b/" + "y" * 20_000, "http:///en/"]


def test_urls_against_plain_rules(spark):
    draw = random.Random(3)
    names = ["com", "net", "example.com", "www.example.com", "bad.org", "a.bad.org", "org"]
    paths = ["/", "/en/", "/en", "/fr/a", "", "/es/"]
    urls = URLS + [f"http://{draw.choice(['', 'm.', 'x.y.'])}{draw.choice(names)}{draw.choice(paths)}{draw.randrange(40)}" for _ in range(400)]
    urls += urls[:40]
    for rules, hosts in (
        (url_filter.RULES, ["Bad.org", None, ""]),
        (sorted({(draw.choice(names) + draw.choice(paths), draw.choice(["allow", "block"])) for _ in range(25)}), ["net"]),
        ([], []),
    ):
        pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, rest string").repartition(3)
        got = url_filter.judge_urls(
            pages, spark.createDataFrame([*rules, (None, "block")], "rule string, action string"),
            spark.createDataFrame([(h,) for h in hosts], "host string")).collect()
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {
            k: judged_by_hand(u, rules, hosts) for k, u in enumerate(urls)}
        assert len(got) == len(urls)


def keys_of(spark, numbers, prefix):
    return spark.createDataFrame([(f"{prefix}{n}",) for n in numbers], "key string")


@pytest.mark.parametrize("bound", [32 << 20, 1000])
def test_cascade_is_exact_on_its_universe(spark, monkeypatch, bound):
    """Long lists against a larger universe; the small bound cuts them into shards."""
    monkeypatch.setattr(url_filter, "FILTER_BYTES", bound)
    universe, listed = keys_of(spark, range(20_000), "k"), keys_of(spark, range(19_000, 22_000), "k")
    built = url_filter.cascades(universe.union(universe.limit(5)), {"some": listed, "none": listed.limit(0)})
    assert (len(built["some"]) == 1) == (bound > 1000)
    assert len(built["some"][0].levels) > 1 and not built["none"][0].levels
    rows = universe.withColumn("keys", F.array("key", F.lit("k7")))
    marked = url_filter.mark(rows, "keys", built).collect()
    assert {r.key for r in marked if r.some[0]} == {f"k{n}" for n in range(19_000, 20_000)}
    assert not any(r.some[1] or r.none[0] for r in marked)


def test_urls_of_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules, hosts = url_filter.rule_table(spark), spark.createDataFrame([], "host string")
    assert url_filter.judge_urls(none, rules, hosts).count() == 0
    with pytest.raises(ValueError, match="verdict"):
        url_filter.judge_urls(none.withColumn("verdict", F.lit("")), rules, hosts)


# ---- Spelling ------------------------------------------------------------------

def near(a, b):
    """Exactly one inserted, deleted or replaced code point apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return max(len(a), len(b)) - head - tail == 1


def variants_by_hand(counts):
    links = {w: [] for w in counts}
    words = sorted(counts)
    for k, a in enumerate(words):
        for b in words[:k]:
            if near(a, b):
                links[a].append(b)
                links[b].append(a)
    forms = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-counts[o], o.encode()), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, counts[w], len(links[w]), counts.get(forms[w])))
    return out


def grouped(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("longest, frequent", [(2, 20_000), (3, 50), (4, 100), (5, 10)])
def test_variants_against_all_pairs(spark, longest, frequent):
    draw = random.Random(longest)
    counts = {}
    for _ in range(150):
        word = "".join(draw.choice("aabce\u00e9") for _ in range(draw.randint(5, 9)))
        counts[word] = draw.randint(3, 400)
        for _ in range(3):
            at, letter = draw.randrange(len(word)), draw.choice("aabxé")
            word = draw.choice([word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:]])
            if len(word) >= 5:
                counts.setdefault(word, draw.randint(3, 100))
    counts |= {"a" * n: 5 for n in range(5, 40)} | {"^$^$^": 9, "^$^$^$": 4, "z" * 4000: 3, "z" * 3999: 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = spelling.group_variants(words, longest=longest, frequent=frequent)
    assert grouped(got) == variants_by_hand(counts)


def test_word_counts_and_damage(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    rows += [(k, f"Straße straße STRASSE colour color×÷ï {'x' * 9} naïve") for k in range(400)]
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(A_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("word", F.lit("w"))
    got = spelling.count_words(docs.repartition(5))
    assert {r.word: r.n for r in got.collect()} == want and any("str" in w and w != "straße" for w in want)
    assert grouped(spelling.group_variants(got)) == variants_by_hand(want)
    assert spelling.group_variants(spelling.count_words(nothing)).count() == 0
