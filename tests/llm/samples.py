"""Texts for the tests."""

import random


def prose(rng, n, lang="en"):
    syllables = {"en": ["th", "er", "on", "an", "re", "he", "in", "ed"], "de": ["sch", "ung", "ein", "ver", "lich", "zu", "ge"],
                 "fr": ["eau", "ou", "ai", "tre", "eux", "que", "elle"]}[lang]
    common = {"en": ["the", "of", "and", "to"], "de": ["der", "die", "und", "das"], "fr": ["le", "la", "et", "les"]}[lang]
    return " ".join(rng.choice(common) if rng.random() < 0.3 else "".join(rng.choices(syllables, k=rng.randint(1, 4)))
                    for _ in range(n))


def edge_rows():
    """Texts of three languages with exact and near copies, shared passages, nulls, empty and very long texts,
    repeated rows and null ids."""
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([3, 40, 120, 300]), lang), lang) for i, lang in
            enumerate(rng.choices(["en", "de", "fr"], k=80))]
    passage = prose(rng, 60)
    rows += [(100 + i, f"{prose(rng, 50)} {passage} {prose(rng, 30)}", "en") for i in range(4)]
    rows += [(110 + i, rows[0][1], "en") for i in range(3)]  # exact copies
    long = prose(rng, 300).split()
    rows += [(120 + i, " ".join([*long[:i * 7], "Changed", *long[i * 7 + 1:]]), "en") for i in range(1, 6)]  # near copies
    rows += [(130, None, "en"), (131, "", "en"), (132, " \n\t ", None), (133, "one", "en"), (134, "123 456 !!!", "en"),
             (135, "x " * 400, "de"), (136, prose(rng, 20_000), "en"), (137, "a\x85b c d", None),
             (138, "  double  spaces\n\nand lines \r\n mixed  ", "en"), (139, "日本 語 ñandú 😀 <|endoftext|> don't", "fr"),
             (None, "no id at all", "en"), (None, None, None), (140, "same row", "en"), (140, "same row", "en"),
             (140, "same id", "en")]
    return rows
