"""SQL fragments for the oracle side (DuckDB)."""

from ..functions.constants import AI_TELLS, CONFUSABLES, LATIN_TO_CYRILLIC, STOPWORDS

WS = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
NOT_WS = r"[^\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
W = r"[\p{L}\p{N}_]"
ZERO_WIDTH = r"[\x{200b}\x{200c}\x{200d}\x{2060}\x{feff}]"
CONTROL = r"[\x00-\x08\x0b-\x1f\x7f-\x{9f}]"
CONTROL_IN = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'), ' ')"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{WS}+|{WS}+\z', '', 'g')"


def urls(x: str) -> str:
    return rf"regexp_replace({x}, 'https?://{NOT_WS}+|www\.{NOT_WS}+', '<URL>', 'g')"


def blobs(x: str) -> str:
    tokens = (f"list_filter(regexp_extract_all({x}, '{W}+'), lambda b: length(b) >= 40 "
              "and regexp_full_match(b, '[A-Za-z0-9]+') and regexp_matches(b, '[0-9]'))")
    return strip(f"list_reduce({tokens}, lambda acc, b: replace(acc, b, ''), {x})")


def dashes(x: str) -> str:
    return collapse(f"regexp_replace({x}, '[-_=]{{5,}}', '', 'g')")


def chain(table: str, keep: str) -> str:
    """Staged cleaning of ``table.text``; the fixtures hold no stutter run."""
    return f"""(SELECT {keep}, {dashes('s3')} AS text FROM (
      SELECT {keep}, {blobs('s2')} AS s3 FROM (
      SELECT {keep}, {urls('s1')} AS s2 FROM (
      SELECT {keep}, {collapse('text')} AS s1 FROM {table}))))"""


def invalid(x: str) -> str:
    return (f"(length({x}) < 20 OR len(regexp_extract_all({x}, '{W}+')) < 5 OR "
            rf"(length({x}) - length(regexp_replace({x}, '\p{{L}}', '', 'g'))) / length({x}) < 0.40)")


def folded(x: str) -> str:
    """Security normalisation; the fixtures are NFKC-stable."""
    frm, to = "".join(CONFUSABLES), "".join(CONFUSABLES.values())
    inner = f"translate(regexp_replace({x}, '{ZERO_WIDTH}', '', 'g'), '{frm}', '{to}')"
    return collapse(f"regexp_replace({inner}, '{CONTROL}', '', 'g')")


def parts(x: str) -> str:
    return rf"string_split(regexp_replace({x}, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1))"


def sentence_list(x: str) -> str:
    return f"list_filter({parts(x)}, lambda p: regexp_matches(p, '{W}'))"


def sentences(table: str, keep: str) -> str:
    """Runtime sentence rows ``keep, total, sent_id, text``."""
    return f"""(SELECT {keep}, len(p) AS total, unnest(range(len(p))) AS sent_id, unnest(p) AS text
      FROM (SELECT {keep}, {sentence_list(collapse('text'))} AS p FROM {table}))"""


LABELLED = ("(SELECT d.doc_id, d.text, l.quality AS label, d.source, d.lang AS prompt "
            "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")
CORPUS = ("(SELECT d.doc_id, d.text, l.quality AS label, d.source, d.lang AS prompt "
          "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
LABELLED_SENTENCES = sentences(LABELLED, "doc_id, label, source, prompt")

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)

_FORMULAS = {
    "char_count": "c",
    "word_count": "n",
    "avg_word_len": "length(array_to_string(w, '')) / greatest(n, 1)",
    "vocab_div_ratio": "list_unique(lw) / greatest(n, 1)",
    "complex_word_ratio": "len(list_filter(w, lambda x: length(x) >= 7)) / greatest(n, 1)",
    "stopword_ratio": f"len(list_filter(lw, lambda x: x IN ({_STOP}))) / greatest(n, 1)",
    "upper_letter_ratio": r"(c - length(regexp_replace(text, '\p{Lu}', '', 'g'))) / greatest(c, 1)",
    "semicolon_dash_count": "c - length(regexp_replace(text, '[;-]', '', 'g'))",
    "char_entropy": "list_entropy(string_split(text, ''))",
    "rep_bigram": ("CASE WHEN n < 3 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - list_unique(list_transform("
                   "range(1, n), lambda i: lw[i] || ' ' || lw[i + 1])) / (n - 1) END"),
    "doc_pos": "_pos / greatest(_total - 1, 1)",
    "numeric_digit_ratio": r"(c - length(regexp_replace(text, '\p{Nd}', '', 'g'))) / greatest(c, 1)",
    "is_first_sent": "CASE WHEN _pos = 0 THEN 1 ELSE 0 END",
    "is_last_sent": "CASE WHEN _pos = _total - 1 THEN 1 ELSE 0 END",
}
_PLACES = {"avg_word_len": 2, "vocab_div_ratio": 2, "complex_word_ratio": 2, "stopword_ratio": 2,
           "upper_letter_ratio": 2, "doc_pos": 2, "char_entropy": 3, "rep_bigram": 3}


def formula(name: str, lexicon=AI_TELLS) -> str:
    if name == "ai_tell_count":
        return " + ".join(f"contains(lower(text), '{e}')::INT" for e in lexicon)
    return _FORMULAS[name]


def features(table: str, keep: str, names, *, pos: str = "0", total: str = "1",
             stored: bool = False, lexicon=AI_TELLS) -> str:
    """Feature rows ``keep, names...`` of ``table.text``; entropy is left unrounded."""
    listed = []
    for name in names:
        value = formula(name, lexicon)
        if stored and name in _PLACES:
            value = f"CAST(format('{{:.{_PLACES[name]}f}}', CAST({value} AS DOUBLE)) AS DOUBLE)"
        listed.append(f"{value} AS {name}")
    where = "WHERE n > 0" if stored else ""
    return f"""(SELECT {keep}, {', '.join(listed)} FROM (
      SELECT *, list_transform(w, lambda x: lower(x)) AS lw, len(w) AS n, length(text) AS c FROM (
      SELECT *, regexp_extract_all(text, '{W}+') AS w, {pos} AS _pos, {total} AS _total
      FROM {table})) {where})"""


def model_margin(model) -> str:
    return " + ".join([f"{w} * {f}" for f, w in model.coefficients.items()] + [str(model.intercept)])


def scored(table: str, keep: str, model, *, text: str = "text", out: str = "score", pos: str = "0",
           total: str = "1") -> str:
    """``keep, out``: probability of the style model for ``table.<text>``."""
    inner = f"(SELECT {keep}, {text} AS text FROM {table})" if text != "text" else table
    return f"""(SELECT {keep}, 1.0 / (1.0 + exp(-({model_margin(model)}))) AS {out}
      FROM {features(inner, keep, list(model.coefficients), pos=pos, total=total)})"""


def hash_key(expr: str, seed="42") -> str:
    return f"('0x' || substr(md5('{seed}:' || {expr}), 1, 8))::BIGINT"


def lookalikes(x: str) -> str:
    return f"translate({x}, '{''.join(LATIN_TO_CYRILLIC)}', '{''.join(LATIN_TO_CYRILLIC.values())}')"


def variants(table: str, keep: str) -> str:
    """Perturbation rows ``keep, text, attack, attacked``."""
    words = f"list_filter(string_split({collapse('text')}, ' '), lambda x: x <> '')"
    zero = ("array_to_string(list_transform(ws, lambda x: CASE WHEN length(x) >= 6 THEN "
            "x[1:length(x)//2] || chr(8203) || x[length(x)//2 + 1:] ELSE x END), ' ')")
    return f"""(SELECT {keep}, text, unnest(['confusables', 'zero_width', 'non_breaking_spaces', 'combined']) AS attack,
      unnest([{lookalikes('text')}, z, array_to_string(ws, chr(160)), replace({lookalikes('z')}, ' ', chr(8201))]) AS attacked
      FROM (SELECT *, {zero} AS z FROM (SELECT *, {words} AS ws FROM {table})))"""
