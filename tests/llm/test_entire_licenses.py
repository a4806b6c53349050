"""Documents that are an entire licence text, in the forms in which such files are found."""

import duckdb
import pytest

from edaphon.llm import licenses
from edaphon.llm.entire_licenses import LONG, SHORT, read

NOTICE = "Copyright (c) 2019 Jo Doe\nAll rights reserved.\n\n"


def documents():
    """(text, identifier): files as they are, and with what people change in them."""
    for name, file, _, _ in LONG:
        yield read(file), name
        yield "\n\n" + read(file).upper().replace("\n", "\r\n"), name
    for name, titles in SHORT:
        yield NOTICE + read(name), name
        if titles[0] != "BSD License":
            yield f"{titles[0]}\n\n{NOTICE}{read(name)}", name
    apache, gpl2, gpl3, bsd = read("Apache-2.0"), read("GPL-2.0"), read("GPL-3.0"), read("BSD-3-Clause")
    yield apache[: apache.index("APPENDIX:")], "Apache-2.0"
    yield apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Jo Doe"), "Apache-2.0"
    yield gpl2[: gpl2.index("How to Apply")], "GPL-2.0"
    yield gpl3.replace("licenses/why-not-lgpl", "philosophy/why-not-lgpl"), "GPL-3.0"
    yield NOTICE + bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "), "BSD-3-Clause"
    yield NOTICE + bsd.replace("copyright holder nor", "<organization> nor"), "BSD-3-Clause"
    yield "The MIT License (MIT)\n\n" + NOTICE + licenses.KNOWN[0][1], "MIT"
    yield apache.replace("perpetual", "temporary"), ""
    yield bsd + "\nand one more condition", ""


def test_entire_texts(spark):
    docs = [(i, text, name) for i, (text, name) in enumerate(documents())]
    rows = spark.createDataFrame(docs, "doc_id long, text string, name string")
    found = {r["doc_id"]: r["whole_license"] for r in licenses.scan_licenses(rows, licenses.known_licenses(spark)).collect()}
    assert {i: found[i] for i, _, _ in docs} == {i: name for i, _, name in docs}
    duck = duckdb.connect()
    duck.execute("create table documents (doc_id bigint, text varchar)")
    duck.executemany("insert into documents values (?, ?)", [(i, text) for i, text, _ in docs])
    assert {r[0]: r[1] for r in duck.execute(licenses.scan_sql()).fetchall()} == found


@pytest.mark.parametrize("name", ["BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "Zlib", "CC0-1.0", "CC-BY-SA-4.0"])
def test_usual_licenses_are_known(name):
    assert any(known == name and len(text) > 500 for known, text in licenses.KNOWN)
