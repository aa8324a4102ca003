"""What the operators must find beyond their first rules, against brute force."""

import itertools
import random

import pytest

from recordwatch.llm import license_scan, line_dedup, line_edits

DOCS = "doc_id long, text string"


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited_lines():
    rng = random.Random(7)
    words = ["w%d" % k for k in range(60)] + ["longword%d" % k for k in range(60)]
    lines = [["the"] * k for k in (3, 4, 5, 9, 10)]
    for size in [4, 5, 6, 8, 10, 15, 30, 60] * 3:
        base = [rng.choice(words) for _ in range(size)]
        lines.append(base)
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randint(1, max(1, size // 5))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
            lines.append(copy)
    rng.shuffle(lines)
    return [" ".join(x) for x in lines if x]


@pytest.mark.parametrize("common", [None, 2])
def test_lines_are_linked_by_edits_alone(spark, monkeypatch, common):
    if common:
        monkeypatch.setattr(line_edits, "SAMPLE", 1.0)
        monkeypatch.setattr(line_edits, "COMMON", common)
    lines = list(dict.fromkeys(edited_lines()))
    group = list(range(len(lines)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, j in itertools.combinations(range(len(lines)), 2):
        x, y = lines[i].split(), lines[j].split()
        if word_edits(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
            group[max(find(i), find(j))] = min(find(i), find(j))
    expected = [line if find(k) == k else "" for k, line in enumerate(lines)]
    rows = spark.createDataFrame(list(enumerate(lines)), DOCS)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(rows, radius=None).collect()}
    assert [got[k] for k in range(len(lines))] == expected
    assert 20 < sum(e == "" for e in expected) < len(lines) - 20


def test_other_characters_are_blanks_between_words(spark):
    same = [("foo,bar baz", "foo, bar baz"), ("a well-known thing", "a well known thing"), ("tab\tin line", "tab in line"), ("\u201cso\u201d \u2013 he\u00a0said", '"so" - he said')]
    rows = spark.createDataFrame([(k, "\n".join(pair)) for k, pair in enumerate(same)], DOCS)
    got = {r.doc_id: (r.text, r.n_kept) for r in line_dedup.dedup_lines(rows, radius=None).collect()}
    assert got == {k: (pair[0], 1) for k, pair in enumerate(same)}


@pytest.mark.parametrize("radius", [3, None])
def test_rows_of_one_id_are_told_apart(spark, radius):
    rows = [(None, "first words here\nshared line of these rows\nonly in one"), (None, "shared line of these rows\nother end\nquite different third"), (4, "p q r\ns t u"), (4, "p q r\nv w x")]
    got = sorted((str(r.doc_id), r.n_kept, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS), radius=radius).collect())
    kept = sorted(line for _, _, text in got for line in text.split("\n"))
    assert kept == sorted({line for _, text in rows for line in text.split("\n")})
    assert [n for _, n, _ in got] == [text.count("\n") + 1 for _, _, text in got]


def test_standard_licences_are_found(spark):
    mit, apache = license_scan.STANDARD["MIT-full"], license_scan.STANDARD["Apache-2.0-header"]
    code = "\n".join(f"x{k} = call_{k}(y{k}, z{k})" for k in range(40))
    texts = [
        f"The MIT License (MIT)\n\nCopyright (c) 2020 Somebody\n\n{mit}", f"{code}\n{mit}\n{code}", "# " + apache.replace("\n", "\n# ") + f"\n{code}", " ".join(mit.split()), code,
        license_scan.STANDARD["GPL-3.0-full"], f"{code}\n{mit}\n{code}\n{mit}",
    ]
    got = {r.doc_id: r for r in license_scan.scan_documents(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    for k, name in enumerate(["MIT-full", "MIT-full", "Apache-2.0-header", "MIT-full", "", "GPL-3.0-full", "MIT-full"]):
        assert name in got[k].licenses.split(","), k
    assert (got[1].best_line, got[1].best_dice) == (40, 1.0)
    assert got[2].best_line == 0 and got[4].n_matches == 0 and got[5].best_line == -1 and got[6].n_matches >= 2
