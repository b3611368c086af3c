import random

import pytest

MESSY = ("doc_id long, text string, lang string, source string, n_chars long, gid int, th string, rest string, "
         "node string, size int, leak string, kind int")


@pytest.fixture(scope="session")
def messy(spark):
    """Near and exact copies, long, empty and null texts, null ids, repeated rows, clashing names."""
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdefgéß") for _ in range(draw.randint(1, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    passage = prose(40)
    base = [prose(80) + "\n" + prose(30) for _ in range(12)]
    texts = []
    for k, text in enumerate(base):
        texts.append(text)
        words = text.split(" ")
        words[5] = "changed"
        texts.append(" ".join(words))
        texts.append(text if k % 3 == 0 else prose(20) + " " + passage + " " + prose(20))
    texts += [None, "", " \n\t", "one", "one", "ONE two three", "one two three", "a" * 500, "a" * 500, "x\n" * 100,
              "Released under the MIT License.\nmit license MIT license", "\n".join([base[0].split("\n")[0]] * 5),
              "é" * 120, "é" * 120, prose(60_000), "same line of more than five words here\n" * 3, "0 1 2 3", "\x00" * 60, "\x00" * 60]
    rows = [(k, t, draw.choice(["en", "de", None]), draw.choice(["a", "b", "ß", None]), None, k % 3, "x", "y", None, -1, "l", 0)
            for k, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, *rows[4][1:]), (None, None, *rows[4][2:]), (None, *rows[4][1:])]
    return spark.createDataFrame(rows, MESSY).repartition(5).cache()


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], MESSY)
