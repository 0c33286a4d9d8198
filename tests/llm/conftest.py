import random

import pytest

EXTRA = {"th": "long", "node": "string", "bucket": "int", "shard": "string", "score": "string", "line": "int", "key": "long", "n_tokens": "string", "found": "int", "rows": "int", "rv_doc": "string", "rv_kept": "long", "rv_lines": "string", "rv_found": "int", "rv_d": "long", "rv_t": "long", "rv_h": "string", "rv_n": "int", "rv_lang": "int", "rv_score": "string", "id.x": "int"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{k}` {v}" for k, v in EXTRA.items())


def prose(seed, n, words=400):
    """n words from a vocabulary that depends on nothing but the seed's parity."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words):x}{'aeiou'[rng.randrange(5)]}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names operators use themselves."""

    def make(rows):
        filled = [(i, t, lang, "s", len(t) if t else None, *([None] * len(EXTRA))) for i, t, lang in (r if len(r) == 3 else (*r, "en") for r in rows)]
        return spark.createDataFrame(filled, SCHEMA)

    return make


LONG = prose(5, 30_000)


@pytest.fixture(scope="session")
def odd(make_docs):
    """Null and empty texts, null ids and labels, repeated rows, equal ids, a very long text, odd characters."""
    return make_docs(
        [(1, None), (2, ""), (3, "   \n\n  "), (None, "no id here, but words\nand lines"), (4, "same text\nsame text"), (4, "same text\nsame text"), (4, "other text of the same id"), (5, LONG, None), (6, "!!! ??? 123"), (7, "naïve Ünïcode — “quotes” 日本語 😀 \u0000 <|endoftext|> don't we'll\ttab"), (-1, "x")]
    )


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])


def sample(spark, data, name):
    return spark.read.parquet(f"{data}/{name}.parquet")
