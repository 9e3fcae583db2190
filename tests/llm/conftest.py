import random
import sys

import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, start long, digest string, "
          "key string, doc string, kept string, words string, n_words long, doc_ids array<long>")


@pytest.fixture(scope="session")
def llm(spark):
    from aevia.llm.common import use_package

    use_package(spark)
    return spark


def prose(rng, n, vocabulary=400):
    return " ".join("".join(rng.choice("abcdeéßñ") for _ in range(1 + rng.randrange(vocabulary) % 7)) for _ in range(n))


def odd_texts():
    """(doc_id, text): nulls, blanks, long texts, long words, copies, near
    copies, shared passages, repeated rows, rows without an id."""
    rng = random.Random(3)
    passage, base = prose(rng, 70), prose(rng, 120).split()
    near = [list(base) for _ in range(6)]
    for k, words in enumerate(near):
        for _ in range(k):
            words[rng.randrange(len(words))] = f"edit{k}"
    rows = [
        (10, None), (11, ""), (12, " \t\n\r\x0b\x0c "), (13, "one"), (14, "One Two"), (15, "one two"),
        (16, "a  b\n\nc \n d\te  "), (17, "x" * 1500), (18, "<|endoftext|> it's we're 'S 123,456.7 #tag ### ✓😀 İ ẞ \u00a0\u2028z"),
        (19, "For " * 300), (20, "same line here\nother\nsame line here\n\n same line here"), (21, "\x00\x1c \x1f\x85 end"),
        (22, prose(rng, 9000)), (23, " ".join(base)), (24, " ".join(base)), (5, " ".join(base)),
        (31, prose(rng, 30) + " " + passage + " " + prose(rng, 25)), (32, passage), (33, prose(rng, 5) + "\n" + passage),
        (34, (passage + " ") * 3), (25, "JUNK!! $$$ *** WORDS!! " * 30), (26, " ".join(passage.split()[:49])),
        (27, " ".join(passage.split()[:50])),
    ]
    rows += [(40 + k, " ".join(w)) for k, w in enumerate(near)]
    rows += [(23, " ".join(base)), (33, passage + " tail"), (None, passage), (None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(llm):
    """The odd texts in a table with columns of clashing names and nulls."""
    rows = [(i, t, None if n % 3 else "en", None if n % 2 else "s", None if t is None else len(t), 0.5, 7, "d", None, "x",
             "k", None, 1, [1, None]) for n, (i, t) in enumerate(odd_texts())]
    return llm.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().split()
