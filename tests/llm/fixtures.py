"""Small tables with the awkward cases every operator has to take."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Names that operators use themselves; carried or ignored, they must not get in the way.
CLASHING = "f1 long, ord long, label string, set long, n long, kept_text string, score double, c0 string, row long"

SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sentences(random: random.Random, n: int, vocabulary: list[str]) -> str:
    return " ".join(random.choice(vocabulary) for _ in range(n))


def texts() -> list[str | None]:
    """Plain texts of two languages, copies, near copies, shared passages, junk and edge cases."""
    dice = random.Random(7)
    vocabularies = [[f"{a}{b}" for a in left for b in right] for left, right in (("the of and to".split(), "ing er ou".split()), ("der und die sch".split(), "ung lich ei".split()))]
    plain = [sentences(dice, dice.randint(30, 160), vocabularies[i % 2]) for i in range(60)]
    passage = sentences(dice, 60, vocabularies[0])
    out: list[str | None] = [*plain]
    out += [plain[0], plain[0], plain[1].replace(" ", "\n"), plain[2].upper()]
    for base in plain[3:15]:
        near = base.split()
        near[dice.randrange(len(near))] = "changed"
        out.append(" ".join(near))
    out += [f"{sentences(dice, 40, vocabularies[0])} {passage} {sentences(dice, 30, vocabularies[0])}" for _ in range(6)]
    out += [passage + " " + passage, "again " * 400, "a b", "a b", "A  B ", "one", "x\ty z", "été ÉTÉ"]
    out += [None, None, "", " \n\t ", "12 34 !!", "### $$$ %%%", " ".join(f"w{i}" for i in range(12000))]
    out += ["HEY!! " * 80, " | ".join(plain[20].split()[:70]), "word$$$ more&&& than%%% that### " * 20]
    return out


def documents(spark: SparkSession, rows: list[str | None] | None = None) -> DataFrame:
    rows = texts() if rows is None else rows
    data = [(i, t, "de" if i % 2 else "en", None if i % 3 else "s", None) + (None,) * 9 for i, t in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def odd_documents(spark: SparkSession) -> DataFrame:
    """The documents, rows without id and whole rows twice over."""
    plain = documents(spark)
    return plain.unionByName(plain.filter("doc_id < 4")).unionByName(
        spark.createDataFrame([(None, t, None, None, None) + (None,) * 9 for t in (None, "lost words", texts()[0])], SCHEMA)
    )


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    """The least member of each one's connected component."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]
