"""Licence notices amid other text, and wrapped ones."""

from __future__ import annotations

import os
import textwrap

import pytest

from ledgerloom.llm import licenses
from ledgerloom.sources.scratch import Scratch

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.fixture(scope="module")
def other(spark):
    """Words of the tables without a notice."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 3000 and not lower(text) like '%licens%'")
    return " ".join(r.text for r in rows.orderBy("doc_id").limit(3).collect()).split()


def found(spark, model, texts: dict) -> dict:
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    return {
        r.doc_id: (r.n_licenses, ",".join(r.families))
        for r in licenses.of_documents(docs, model, Scratch(spark)).collect()
    }


def every_template():
    return [(f"{family} {i}", family, t) for family, ts in licenses.TEMPLATES.items() for i, t in enumerate(ts)]


def test_notices_in_long_lines(spark, model, other):
    """The result does not depend on how much other text shares the line."""
    texts, expected = {"none": " ".join(other)}, {"none": (0, "")}
    for name, family, text in every_template():
        for at in (0, 37, 403, len(other)):
            texts[f"{name} {at}"] = " ".join([*other[:at], text, *other[at:]])
            expected[f"{name} {at}"] = (1, family)
    mit, by = "Released under the MIT License.", "Licensed under CC BY 4.0."
    texts["both"] = " ".join([*other[:50], mit, *other[50:200], by, *other[200:]])
    texts["twice"] = " ".join([*other[:50], mit, *other[50:200], mit, *other[200:]])
    texts["beside"] = " ".join([*other[:50], mit, by, *other[50:]])
    expected |= {"both": (2, "CC-BY,MIT"), "twice": (2, "MIT"), "beside": (2, "CC-BY,MIT")}
    got = found(spark, model, texts)
    assert {k: (got[k], v) for k, v in expected.items() if got[k] != v} == {}


def test_wrapped_notices(spark, model, other):
    """A paragraph is what stands between blank lines, without comment marks."""
    texts, expected = {}, {}
    for name, family, text in every_template():
        for width, mark in ((80, ""), (60, "# "), (40, " * ")):
            lines = "\n".join(mark + line for line in textwrap.wrap(text, width))
            texts[f"{name} {width}"] = lines
            texts[f"{name} {width} apart"] = f"one two three\n{mark}\n{lines}\n\nfour five six"
            texts[f"{name} {width} amid"] = " ".join(other[:30]) + f"\n{lines}\n" + " ".join(other[30:60])
    expected = {k: (1, k.split()[0]) for k in texts}
    gpl = "\n".join(textwrap.wrap(licenses.TEMPLATES["GPL-3.0"][2], 50))
    texts["several"] = f"Released under the MIT License.\n{gpl}\nLicensed under CC BY 4.0."
    expected["several"] = (3, "CC-BY,GPL-3.0,MIT")
    got = found(spark, model, texts)
    assert {k: (got[k], v) for k, v in expected.items() if got[k] != v} == {}
