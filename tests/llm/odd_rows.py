"""Documents with every oddity at once: nulls, empty and long texts, ties, repeats, clashing column names."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use for columns of their own.
    "id string, k1 int, k2 int, score int, label int, place int, spans int, fingerprint int, ranges int, "
    "carried0 int, c0 int, ids int, words int, block int, component int, node int, features int, n_words int"
)
EXTRA = 18


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    prose = [" ".join(word() for _ in range(n)) for n in (1, 2, 12, 13, 34, 35, 36, 80, 200, 900)]
    passage = " ".join(word() for _ in range(60))
    return [
        None,
        "",
        " \t\n ",
        *prose,
        prose[7],  # an exact copy
        prose[8].replace(" ", "  \n", 3).upper(),
        f"{prose[2]} {passage} {prose[3]}",
        f"{passage}\n{prose[6]} {passage}",
        " ".join(["ha"] * 300),
        "x" * 200_000,
        " ".join(word() for _ in range(30_000)),
        "日本語 é ñ    <|endoftext|> don't we'll 12345 !!! \r\n\r\n   end",
        "</s>[INST] \\<s> <\\s> [/INST]",
        "\x00\x1c\x85​ odd \U0001f600 signs",
    ]


def rows():
    out = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts())]
    out += [(None, texts()[9], None, None, None), (None, None, None, None, None), out[9], out[9], (9, "other text", "", "", 1)]
    return [(*row, "x", *([7] * (EXTRA - 1))) for row in out]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)
