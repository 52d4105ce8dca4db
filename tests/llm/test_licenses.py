from __future__ import annotations

import pytest
from helpers import odd_documents
from leaguelake.llm import licenses


def _scan(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.id: [(m.licence, m.dice) for m in r.matches] for r in licenses.scan(docs, **options).collect()}


def test_lines_paragraphs_and_whole_texts(spark):
    mit = licenses.TEMPLATES["MIT text"]
    found = _scan(spark, [
        "Some prose.\nLicensed under the Apache License, Version 2.0.\nMore.",
        "Before.\n\n" + mit.replace("free of charge", "without charge").replace(", ", ",\n") + "\n\nAfter, much later.",
        mit.upper(),
        "licensed under the apache license version 2.1",
        "All rights reserved.\nALL RIGHTS   RESERVED",
        "This is no notice, but talks of a license and of rights.",
    ])
    assert found[0][0] == ("Apache-2.0", 1.0)  # its line; the whole text is near as well
    assert {name for name, _ in found[0]} == {"Apache-2.0"}
    assert found[1][0][0] == "MIT text" and 0.9 < found[1][0][1] < 1
    assert found[2] == [("MIT text", 1.0)]
    assert [name for name, _ in found[3]] == ["Apache-2.0"]
    assert [name for name, _ in found[4]] == ["All rights reserved"] * 3
    assert found[5] == []


def test_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [r.text for r in rows] + list(licenses.TEMPLATES.values())
    found = _scan(spark, texts, threshold=0.5)

    def bigrams(words):
        return set(zip(words, words[1:]))

    import re

    for i, text in enumerate(texts):
        units = text.split("\n") + (re.split("\n\n+", text) if "\n\n" in text else []) + ([text] if "\n" in text else [])
        expected = []
        for unit in units:
            a = bigrams(re.findall(r"[^\W_]+", unit.lower()))
            for name, template in licenses.TEMPLATES.items():
                b = bigrams(licenses.template_words(template))
                if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.5:
                    expected.append((name, 2 * len(a & b) / (len(a) + len(b))))
        assert found[i] == [(n, pytest.approx(d)) for n, d in sorted(expected, key=lambda m: (-m[1], m[0]))]


def test_notices_inside_longer_texts(spark):
    import textwrap

    prose = "\n".join(textwrap.wrap(" ".join(f"plain{i} word" for i in range(100)), 78))
    bsd = licenses.TEMPLATES["BSD-2-Clause text"].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ")
    apache = licenses.TEMPLATES["Apache-2.0 notice"].replace(" You may", "\nYou may").replace(" http", "\n\n    http")
    apache = apache.replace(" Unless", "\n\nUnless")
    inside = ["MIT text", "GPL-3.0 notice", "MPL-2.0 notice", "ISC text"]
    texts = [f"{prose}\n{textwrap.fill(licenses.TEMPLATES[name], 78)}\n{prose}" for name in inside]
    texts += [f"{prose} Released under the MIT License. {prose}", f"{prose}\n\n{bsd}\n\n{prose}", bsd, apache]
    flat = prose.replace("\n", " ")
    texts += [f"{flat} {licenses.TEMPLATES['MIT text'].replace('sublicense', 'pass on')} {flat}", f"{prose} licence {prose}"]
    found = [[(name, round(dice, 6)) for name, dice in m] for _, m in sorted(_scan(spark, texts).items())]
    assert found[:4] == [[(name, 1.0)] for name in inside]
    assert found[4] == [("MIT", 1.0)]
    assert found[5] == found[6] == [("BSD-2-Clause text", 1.0)]
    assert ("Apache-2.0 notice", 1.0) in found[7]
    assert [name for name, _ in found[8]] == ["MIT text"] and 0.9 < found[8][0][1] < 1
    assert found[9] == []


def test_best_window_is_that_of_brute_force(spark):
    import random

    drawn = random.Random(5)
    template = "a b c d e f g h"
    b = set(zip(template.split(), template.split()[1:]))
    texts = []
    for _ in range(150):
        words = [f"x{n}" for n in range(12)] + template.split() + [f"y{n}" for n in range(12)]
        for _ in range(drawn.randrange(4)):
            words[drawn.randrange(len(words))] = drawn.choice("abcdx")
        texts.append(" ".join(words))
    found = _scan(spark, texts, templates={"t": template}, threshold=0.6)

    def dice(a):
        return 2 * len(a & b) / (len(a) + len(b))

    for i, text in enumerate(texts):
        pairs = list(zip(text.split(), text.split()[1:]))
        longest = int(len(b) * 1.4 / 0.6)
        best = max(dice(set(pairs[x : x + n])) for x in range(len(pairs)) for n in range(1, longest + 1))
        assert found[i] == ([("t", best)] if best >= 0.6 else [])


def test_odd_rows_and_own_templates(spark):
    docs = odd_documents(spark)
    rows = licenses.scan(docs, {"pair": "one two", "word": "one"}).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(len(r.matches))
    assert by[1] == by[2] == by[3] == by[8] == [0]
    assert by[4] == by[7] == [1] and by[5] == [1, 1] and sorted(by[None]) == [0, 1]
    assert licenses.scan(odd_documents(spark, [])).count() == 0


def test_template_bigrams_are_fixed_values(spark):
    """Hashes made by lambdas are not folded, so every unit of every row made those of all templates again."""
    docs = spark.createDataFrame([(1, "Some prose.\nReleased under the MIT License.\n\nMore.")], "doc_id long, text string")
    found = licenses.scan(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "[released,under" not in plan  # words of a template, to be hashed
    assert [(m.licence, m.dice) for m in found.first().matches] == [("MIT", 1.0), ("MIT", 0.8)]  # its line and its paragraph
