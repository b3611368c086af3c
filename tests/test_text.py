import random
import re
import unicodedata

import regex
from pyspark.sql import functions as F

from quillstat.functions import chars, style, text as tx
from quillstat.functions.constants import CONFUSABLES
from quillstat.operators import cleaning, quality, sentences

def test_clean_text_folds_compatibility_forms_and_whitespace(one):
    assert one(tx.clean_text, ["ﬁne  １２ x", "  a　b  c\x1cd ", "é"]) == [
        "fine 12 x", "a b c d", "é"]


def test_urls_blobs_stutter_and_dashes(one):
    assert one(tx.replace_urls, ["see https://a.b/c?d and www.x.y now"]) == ["see <URL> and <URL> now"]
    with_digit, without, short = "a1" * 20, "a" * 40, "a1" * 19 + "b"
    assert one(tx.strip_blobs, [f"x {with_digit}", without, short]) == ["x", without, short]
    assert one(tx.strip_stutter, ["a s-S-s-s-s-s b", "s-s-s", "as-s-s-s-s-s"]) == [
        "a  b", "s-s-s", "as-s-s-s-s-s"]
    assert one(tx.strip_dash_runs, ["a ----- b", "a -- b"]) == ["a b", "a -- b"]


def test_invalid_entry_limits(one):
    letters = "a b c d " + "e" * 11
    assert one(tx.invalid_entry, [
        letters, letters + "e", "a b c dddddddddddddddd", "a b c d eeeeeeeeeeee",
        "a1 b2 c3 d4 555555555555", "", "aaaaaaaa 1 2 3 45678",
    ]) == [True, False, True, False, True, True, False]


def test_security_normalise(one):
    got = one(tx.security_normalise, [
        "Ｃоmprеhеnsіve​ analysis", "a\rb", "a\nb", "".join(CONFUSABLES)])
    assert got == ["Comprehensive analysis", "ab", "a b", "".join(CONFUSABLES.values())]


def test_stable_characters_never_change_under_nfkc():
    second = {unicodedata.normalize("NFD", chr(c))[1:2] for c in range(0x110000)
              if not 0xD800 <= c <= 0xDFFF}
    pattern = regex.compile(re.sub(
        r"\\x\{(\w+)\}", lambda m: "\\U%08x" % int(m[1], 16), chars.maybe_unnormalised()))
    stable = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF and not pattern.search(chr(c))]
    assert len(stable) > 20_000
    assert all(unicodedata.normalize("NFKC", c) == c for c in stable)
    # None of them can be the trailing half of a composition.
    assert not [c for c in stable if c in second and c]


def test_nfkc_agrees_with_python_on_random_text(one):
    rng = random.Random(3)
    alphabet = "abc ȩ́́ﬁ１​ａ가각ᄀᆨᅡÅÅ …－ͅ"
    texts = ["".join(rng.choice(alphabet) for _ in range(12)) for _ in range(300)]
    assert one(tx.nfkc, texts) == [unicodedata.normalize("NFKC", x) for x in texts]


def test_python_round_matches_python(spark):
    rng = random.Random(1)
    values = [2.675, 0.285, 0.125, 0.005, 0.0005, 0.0015, 4.35, 1.005, 0.0, 20.015, 7.5]
    values += [rng.randrange(1, 4000) / rng.randrange(1, 400) for _ in range(3000)]
    values += [k / 2000 for k in range(1, 4001)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    rows = frame.select("v", tx.python_round(F.col("v"), 2).alias("two"),
                        tx.python_round(F.col("v"), 3).alias("three")).collect()
    wrong = [r for r in rows if (r["two"], r["three"]) != (round(r["v"], 2), round(r["v"], 3))]
    assert not wrong, wrong[:5]


def test_words_and_unicode_classes(one):
    assert one(tx.words, ["Héllo x‍y ½ _q"]) == [["Héllo", "x", "y", "½", "_q"]]
    assert one(lambda t: tx.count_class(t, chars.digit_class()), ["a1²③٣"]) == [4]


def test_sentence_numbering(spark):
    frame = spark.createDataFrame([(1, "Hi. ... Bye."), (2, "..."), (3, "One? Two! x")], "doc_id int, text string")
    runtime = {(r.doc_id, r.sent_id, r.total, r.text) for r in sentences.split_runtime(frame).collect()}
    stored = {(r.doc_id, r.sent_id, r.total, r.text) for r in sentences.split_corpus(frame).collect()}
    rest = {(3, 0, 3, "One?"), (3, 1, 3, "Two!"), (3, 2, 3, "x")}
    assert runtime == {(1, 0, 2, "Hi."), (1, 1, 2, "Bye.")} | rest
    assert stored == {(1, 0, 3, "Hi."), (1, 2, 3, "Bye.")} | rest


def test_counts_and_display(spark):
    frame = spark.createDataFrame([("a b  c. dé", "a b c. dé"), ("One.​ Two.", "One. Two.")],
                                  "text string, normalised string")
    rows = sentences.display_sentences(sentences.text_counts(frame)).collect()
    assert (rows[0].characters, rows[0].bytes, rows[0].whitespace_words, rows[0].sentence_count) == (
        len(rows[0].text), len(rows[0].text.encode()), 4, 2)
    assert rows[0].display == ["a b  c.", "dé"] and rows[0].aligned
    assert rows[1].display == ["One.", "Two."] and not rows[1].aligned


def test_admission_codes(spark):
    texts = {
        "   ": "EMPTY_TEXT", "": "EMPTY_TEXT", None: "EMPTY_TEXT", "Too short": "TEXT_TOO_SHORT",
        "a" * 10_001: "TEXT_TOO_LARGE", "😀" * 10_000: "NO_WORDS", "a" * 20 + "\x00": "UNSAFE_CONTROL_CHARACTER",
        "Hello there. " * 101: "TOO_MANY_SENTENCES", "Hello there. " * 100: None, "." * 30: "NO_WORDS",
        "x" * 19 + "\r\n\t": "TEXT_TOO_SHORT", "x" * 20 + "\r\n\t": None,
        "Full width stops．" + " more." * 3: None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.reject_code for r in quality.admit(frame).collect()}
    assert got == texts
    assert quality.accepted(quality.admit(frame)).count() == 3


def test_cleaning_filters_and_audit(spark):
    rows = [("A long enough text with words. https://x.y", 1), ("   ", 0), (None, 1), ("tiny", None)]
    frame = spark.createDataFrame(rows, "text string, label int")
    assert [r.text for r in cleaning.drop_missing(frame).collect()] == [rows[0][0]]
    audit = cleaning.cleaning_audit(frame).first()
    assert (audit.rows_in, audit.rows_missing, audit.rows_url_changed, audit.rows_invalid, audit.rows_valid) == (4, 2, 1, 1, 1)
    folded = cleaning.normalise_for_scoring(frame.where("text like 'A%'")).first()
    assert not folded.normalisation_applied
    assert cleaning.standardise_text(frame).where("text = ''").count() == 2


def test_normalising_twice_changes_nothing(one):
    texts = ["Ｃоm​prе x", "a b\x07", "plain"]
    once = one(tx.security_normalise, texts)
    assert one(tx.security_normalise, once) == once


def test_counted_words_are_those_of_the_expressions(spark):
    """Few and many kinds of characters, blanks of all kinds, no word, no text."""
    many = "".join(chr(c) + (" " if c % 7 == 0 else "") for c in range(0x4E00, 0x4F00))
    texts = ["\u00dcber \u0130stanbul, \u00fcber_all; the THE of\u00bd", "\u2028 a\xa0b\x1cc\u200bd", "...", "", None, many, "\u0391\u03a3 \u0391\u03a3\u0391"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    low = F.split(F.lower(F.array_join(tx.words(F.col("text")), " ")), " ")
    got = style.stylometry(frame.withColumn("t", F.col("text")), features=("word_count", "vocab_div_ratio", "avg_word_len"))
    for r in got.withColumns({"n": F.size(tx.words(F.col("t"))), "kinds": F.size(F.array_distinct(low))}).collect():
        assert r.word_count == (r.n if r.t is not None else None)
        assert r.vocab_div_ratio == (r.kinds / r.n if r.n and r.t else 0)
