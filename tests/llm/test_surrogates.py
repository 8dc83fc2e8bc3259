"""Surrogates: forms with few values, names by themselves, and one kind against a plain rule."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftledger.llm import surrogates
from shiftledger.llm.neighbours import nearest_neighbours


def rewritten(spark, texts, key="key"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in surrogates.replaced(df, key)[0].orderBy("doc_id").collect()]


def test_a_form_with_too_few_values_grows(spark):
    """All 676 addresses of the form; none may be an original or shared."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [f"{a}@{b}.co" for a in letters for b in letters]
    out = rewritten(spark, texts)
    assert len(set(out)) == 676 and not set(out) & set(texts)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.co", t) for t in out)


@pytest.mark.parametrize("kind, value, form", [
    ("N", "123-45-6789", r"\d{3}-\d{2}-\d{4}0*\d*"), ("P", "+1 449 555 7462", r"\+1 \d{3} \d{3} \d{4}\d+"),
    ("C", "4111 1111 1111 1111", r"[\d ]{20,}"), ("I", "10.0.0.1", r"(\d+\.){4,}\d+"),
    ("K", "ghp_abcdefghijklmnop", r"ghp_[a-z]{17,}"), ("E", "x@y.co", r"[a-z]{2,}@[a-z]\.co"),
])
def test_longer_forms_are_of_the_kind(spark, kind, value, form):
    drawn = surrogates.surrogate("k", F.lit(kind), F.lit(value), F.lit(surrogates.DRAWS)).alias("s")
    assert re.fullmatch(form, spark.range(1).select(drawn).first()[0])


def test_names_keep_their_reference_without_honorific(spark):
    text = "Mr John Smith came. Later Smith said that John agreed; Smithson and Johnny did not. Write to John.Smith@x.org"
    other = "Smith is no name here, nor is John"
    first, second = rewritten(spark, [text, other])
    found = re.fullmatch(
        r"Mr (\w+) (\w+) came\. Later (\w+) said that (\w+) agreed; Smithson and Johnny did not\. Write to (\S+)@(\w)\.org", first
    )
    given, surname, again, given_again, mail, _ = found.groups()
    assert (surname, given) == (again, given_again) and {given, surname}.isdisjoint({"John", "Smith"})
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[A-Z][a-z]{4}", mail) and mail != "John.Smith"
    assert second == other


def test_cyrillic_surnames_keep_their_gender(spark):
    (text,) = rewritten(spark, ["Г-н Иванов и Г-жа Петрова; Петрова ушла"])
    he, she, again = re.fullmatch(r"Г-н (\w+) и Г-жа (\w+); (\w+) ушла", text).groups()
    assert she == again and she[-1] in "ая" and he[-1] not in "ая" or he.endswith("енко")


def plain(key, value):
    """A social security number by the rule: the first draws that are nobody's."""
    seed = f"{key}|N|0|{value}"
    drawn = bytes.fromhex(hashlib.sha512(f"{seed}|0".encode()).hexdigest() + hashlib.sha512(f"{seed}|1".encode()).hexdigest())
    return "".join(str(drawn[n % 128] % 10) if c.isdigit() else c for n, c in enumerate(value))


def test_numbers_against_the_plain_rule(spark):
    values = [f"{n:03}-{n % 90 + 10}-{n * 37 % 10000:04}" for n in range(1, 300)]
    expected = [plain("key", v) for v in values]
    assert len(set(expected) | set(values)) == 2 * len(values)
    assert rewritten(spark, [f"number {v}." for v in values]) == [f"number {v}." for v in expected]


def test_equal_vectors_with_extreme_components_score_one(spark):
    rows = [(50, [1e200, 2e200]), (51, [1e200, 2e200]), (52, [1e-200, 2e-200]), (100, [5e-324, 0.0]), (101, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in nearest_neighbours(df, F.col("vec_id") % 50 == 0).collect()}
    assert np.isclose([found[50, 51], found[50, 52], found[100, 101]], 1.0).all()
    assert not any(np.isnan(score) for score in found.values())
