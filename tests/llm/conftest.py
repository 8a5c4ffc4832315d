import random

import pytest

#: Extra columns of the messy table; some have names that operators use inside.
EXTRA = "key string, row int, part int, node string, chunk string, probabilities int, digest string, label int"


def messy_rows():
    """(doc_id, text): copies, near copies, shared passages, nulls, empty and long texts, odd characters, repeats."""
    rng = random.Random(7)
    stock = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(stock) for _ in range(n))
    base, passage = prose(120), prose(40)
    words = base.split()
    rows = [(n, prose(rng.randint(1, 60))) for n in range(20)]
    rows += [(20, base), (21, base), (22, base.upper()), (23, base + " end"), (24, " ".join(words[:60] + ["new"] + words[61:]))]
    rows += [(25, " ".join(words[:118])), (26, " ".join(["x"] + words[1:])), (27, prose(30) + " " + passage + " " + prose(30))]
    rows += [(28, passage), (29, prose(10) + "\n" + passage + "."), (30, prose(12_000)), (31, "aba " * 500), (32, "aba " * 700 + "b")]
    rows += [(33, None), (34, ""), (35, " \t\n "), (36, None), (37, "one two"), (38, "ONE  two"), (39, "İSTANBUL Ω Å ǅ Ⅷ ÉCOLE\x00\x1f")]
    rows += [(40, "one two three four"), (41, "  lead"), (42, "trail  "), (43, "a" * 3000), (44, "\U0001f600 smile \U0001f600" * 9)]
    rows += [(None, base), (None, "no key here"), (20, base), (45, prose(20)), (45, prose(20)), (-7, passage)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    rows = [(d, t, "x" if d else None, None, d, None, "c", 1, None, 0) for d, t in messy_rows()]
    return spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("false")
