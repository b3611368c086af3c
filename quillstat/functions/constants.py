"""Values that have to equal the published ones for results to agree."""

# ---- Fixed values: feature names, in output order --------------------------
NUMERIC_FEATURES = (
    "char_count", "word_count", "avg_word_len", "vocab_div_ratio",
    "complex_word_ratio", "stopword_ratio", "upper_letter_ratio",
    "semicolon_dash_count", "char_entropy", "rep_bigram",
    "ai_tell_count", "doc_pos",
)
EXTRA_FEATURES = ("numeric_digit_ratio", "is_first_sent", "is_last_sent")
CLUSTER_FEATURES = (
    "avg_word_len", "vocab_div_ratio", "complex_word_ratio", "stopword_ratio",
    "semicolon_dash_count", "upper_letter_ratio", "char_entropy", "rep_bigram",
)
HISTOGRAM_FEATURES = (
    "avg_word_len", "vocab_div_ratio", "complex_word_ratio", "stopword_ratio",
    "char_entropy", "rep_bigram", "ai_tell_count", "upper_letter_ratio",
)

# ---- Fixed values: stop words ----------------------------------------------
STOPWORDS = tuple(
    "a an the and or but if while of to in on for with as by at from "
    "is are were be been being this that these those it its he she "
    "they we you i not no do does did has have had will would can could "
    "should may might must about over under again further there here "
    "their our your".split()
)

# ---- Fixed values: lexicon of phrases counted by ai_tell_count --------------
AI_TELLS = (
    "delve", "tapestry", "underscore", "moreover", "furthermore",
    "in conclusion", "it is important to note", "a testament to",
    "navigating", "realm of", "leverage", "utilize", "facilitate",
    "comprehensive", "multifaceted", "nuanced", "paradigm", "ever-evolving",
    "crucial", "pivotal", "seamless", "robust", "holistic", "intricate",
    "plethora", "additionally", "in summary", "overall", "notably",
    "consequently", "in essence", "foster", "embark", "elevate", "unlock",
    "harness", "vibrant", "bustling", "meticulous", "testament",
    "landscape of", "world of", "when it comes to",
)

# ---- Fixed values: label vocabularies ---------------------------------------
CORPUS_LABELS = {
    "AI": 1, "ai": 1, "machine": 1, "generated": 1, "chatgpt": 1, "gpt": 1,
    "Human": 0, "human": 0, "real": 0,
}
LOADER_LABELS = {
    "0": 0, "human": 0, "human-written": 0, "human_written": 0,
    "1": 1, "ai": 1, "ai-generated": 1, "ai_generated": 1,
}
LABEL_NAMES = {0: "human", 1: "ai"}

# ---- Fixed values: column names accepted for text and label -----------------
TEXT_ALIASES = ("text", "content", "abstract", "essay", "body")
LABEL_ALIASES = (
    "author", "label", "target", "class", "is_ai", "category", "type",
    "origin", "source",
)

# ---- Fixed values: Cyrillic and Greek letters folded to Latin look-alikes ----
CONFUSABLES = {
    "а": "a", "А": "A", "е": "e", "Е": "E", "о": "o", "О": "O",
    "р": "p", "Р": "P", "с": "c", "С": "C", "х": "x", "Х": "X",
    "і": "i", "І": "I", "ј": "j", "Ј": "J", "у": "y", "У": "Y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Χ": "X", "Υ": "Y", "ο": "o", "ρ": "p", "ν": "v",
}
# ---- Fixed values: Latin letters replaced by the robustness generator --------
LATIN_TO_CYRILLIC = {
    "a": "а", "e": "е", "o": "о", "p": "р", "c": "с", "x": "х", "i": "і",
}

# ---- Fixed values: admission limits ------------------------------------------
MIN_CHARACTERS = 20
MAX_CHARACTERS = 10_000
MAX_BYTES = 40_000
MAX_SENTENCES = 100

# ---- Fixed values: model registry order, names and likelihood bands ----------
MODEL_ORDER = ("logistic_regression", "linear_svm", "xgboost")
DISPLAY_NAMES = {
    "logistic_regression": "Logistic Regression",
    "linear_svm": "Linear SVM",
    "xgboost": "XGBoost",
}
BANDS = (("strong", 0.9), ("moderate", 0.7), ("low", 0.5))

# Fixed value: callers compare the name of the interval method.
INTERVAL_METHOD = "95% bootstrap interval across sentence AI probabilities"
