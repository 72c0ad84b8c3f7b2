"""Small tables for the tests of the corpus operators."""

import random

# Extra columns that are named like ones the operators make.
EXTRA = (
    "hash bucket node key keys anchor doc version place label terms slot n rows rank score kept row id sha shorter "
    "_hp_id _hp_sha _hp_kept _hp_doc _hp_text _hp_version a.b x.text"
)

WORDS = "the quick brown fox jumps over lazy dog été déjà niño größe α Ωmega 数据 a1 don't (x) e.g. 12 3.5 *** !! | http://a.b/c".split()


def text_of(rng: random.Random, words: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", "\n", ". ", "\t", " "]) for _ in range(words))


def frame(spark, rows):
    """`doc_id`, `text` and clashing extra columns."""
    extra = "".join(f", `{name}` string" for name in EXTRA.split())
    schema = f"doc_id long, text string, lang string, source string, n_chars long{extra}"
    data = [(i, t, None, "s", None if t is None else len(t), *[None] * len(EXTRA.split())) for i, t in rows]
    return spark.createDataFrame(data, schema)


def corpus(seed: int = 0, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Texts with nulls, empty and very long ones, copies, near copies, and repeated rows."""
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = [(i, text_of(rng, rng.randint(1, 120))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "word"), (n + 4, "two words"), (n + 5, "x" * 20_000)]
    rows += [(n + 6, text_of(rng, 8_000)), (n + 7, "ab " * 700), (None, "no id"), (None, None)]
    rows += [(n + 8 + i, rows[i][1]) for i in range(6)]  # copies
    rows += [(n + 20 + i, (rows[i][1] or "").upper()) for i in range(3)]
    rows += [(n + 30 + i, rows[i + 10][1] + "and one more end") for i in range(6)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (7, "another text of this id")]  # repeated ids
    return rows
