"""Line dedup against a plain restatement of its rule."""

from __future__ import annotations

import random

import pytest

from shiftledger.llm.lines import without_common_lines

BLANK = " \t\n\x0b\x0c\r"
#: Names that the operator uses itself, one with a dot.
SCHEMA = "doc_id long, text string, version string, position string, `keeper.x` int, of int, dropped int, first_half int"
EXTRA = ("v", "p", 1, 2, 3, 4)


def lowered(line):
    return "".join(c.lower() if c.isascii() else c for c in line).strip(BLANK)


def expected(rows, least=20, documents=3):
    holders: dict[str, set] = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(lowered(line)) >= least:
                holders.setdefault(lowered(line), set()).add(doc_id)
    keeper = {
        key: max((i for i in ids if i is not None), default=None)
        for key, ids in holders.items()
        if len(ids) >= documents
    }
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [li for li in lines if lowered(li) not in keeper or keeper[lowered(li)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(spark, rows, **options):
    documents = spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, without_common_lines(documents, **options).collect()), key=str)


def test_cases(spark):
    line, other = "Żółw idzie w las o świcie", "the quick brown fox jumps"
    rows = [
        (1, f"{line}\nown\n{line}"),
        (2, f"  {line.replace('idzie', 'IDZIE')}\t"),
        (3, f"{line}\n\n{line}\r\nx"),  # the largest id that holds it keeps every repeat
        (3, f"{line}\nother text of the same id"),
        (4, f"{other}\n{other}\n{other}"),  # three lines of one document
        (5, f"{other} \n"),
        (6, "short line\nshort line"),
        (7, "short line"),
        (8, "short line"),
        (9, None),
        (10, ""),
        (None, f"{line}\nwithout an id"),
        (None, f"{line}\nwithout an id"),
        (None, None),
        (11, "\n\n\n"),
        (12, f"{line}x" * 3),
        (1, f"{line}\nown\n{line}"),  # a repeated row
    ]
    result = found(spark, rows)
    assert result == expected(rows)
    assert (2, 1, 1, "") in result and (3, 4, 0, f"{line}\n\n{line}\r\nx") in result


@pytest.mark.parametrize("least, documents", [(20, 3), (1, 2), (0, 1)])
def test_random_texts(spark, least, documents):
    rng = random.Random(least)
    pool = [" ".join(rng.choice(["ala", "ma", "KOTA", "ś", "żaba"]) for _ in range(rng.randint(0, 9))) for _ in range(40)]
    rows = [(rng.choice([None, *range(30)]), "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for _ in range(60)]
    rows.append((31, "\n".join(rng.choice(pool) for _ in range(20_000))))
    assert found(spark, rows, min_chars=least, min_documents=documents) == expected(rows, least, documents)


def test_ids_at_the_threshold(spark):
    """19 code points never go, 20 do; two documents keep a line, three do not."""
    rows = [(i, "ś" * 19 + "\n" + "ś" * 20 + ("\n" + "q" * 30 if i < 2 else "")) for i in range(3)]
    result = found(spark, rows)
    assert result == expected(rows)
    assert [r[2] for r in result] == [1, 1, 0]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_no_python_workers(spark):
    documents = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = without_common_lines(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
