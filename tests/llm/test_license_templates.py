import pytest

from riskloom.llm import licenses


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
def test_each_notice_alone_gets_its_label(scanner, label):
    for text in licenses.TEMPLATES[label]:
        found = scanner.scan(f"Foo bar. {text}. Baz")
        assert label in found["labels"].split(",") and found["score"] == 1.0, text


def test_the_plain_apache_line(scanner):
    found = scanner.scan("Et alia. Licensed under the Apache License, Version 2.0. Fin.")
    assert found["labels"] == "apache-2.0" and found["spans"] == "apache-2.0:2:10"
    cut_off = scanner.scan('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file')
    assert cut_off["labels"] == "apache-2.0"


def test_full_texts_with_words_changed(scanner):
    for label, texts in licenses.stated_templates().items():
        words = texts[-1].split()
        for i in range(40, len(words), 97):
            words[i] = "zzzz"
        found = scanner.scan("before it " + " ".join(words) + " after it")
        assert label in found["labels"].split(","), label


def test_notices_of_other_licenses_stay_apart(scanner):
    for text, label in [
        ("licensed under the GNU General Public License version 2", "gpl"),
        ("licensed under the GNU General Public License version 3", "gpl"),
        ("licensed under the GNU Lesser General Public License version 3", "gpl,lgpl"),
    ]:
        assert scanner.scan(text)["labels"] == label


def test_templates_as_a_dictionary_or_a_table(spark):
    docs = spark.createDataFrame([(1, "given under The House Terms, of today"), (2, "licensed under the MIT license")], "doc_id long, text string")
    own = {"house": ["under the house terms of today", "house terms"]}
    table = spark.createDataFrame([(k, t) for k, ts in own.items() for t in ts], "label string, text string")
    for templates in (own, table):
        got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(docs, templates).collect()}
        assert got == {1: "house", 2: ""}
    assert {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(docs).collect()} == {1: "", 2: "mit"}
