"""Encoding, exact copies, near copies, fingerprints, lines, licences and chats against plain versions of themselves."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from recordwatch.llm import bpe, chat, exact_dedup, fingerprints, license_scan, line_dedup, simhash_dedup
from recordwatch.llm.components import connected
from recordwatch.llm.queries import tokenizer_path

ODD = [
    None, "", " \t\n", "it's I'LL can't<|endoftext|>x <|ENDOFTEXT|>", "naïve ÀÉÎ ΣΑΣ İstanbul ß ﬁ 北京 12½ ²x", "a\x1cb c\x85d\xa0e f", "<|<|endoftext|>|>",
    "नमस्ते १२३ 🙂🙂 ö̈", "x" * 5000, "word " * 3000,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, fp long"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "en", "s", len(t or ""), 0.5, k, k) for k, t in enumerate(texts)], SCHEMA)


def test_bpe_is_the_librarys(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in bpe.encode_documents(docs_of(spark, ODD), tokenizer_path()).collect()}
    digests = {r.doc_id: r for r in bpe.encode_digests(docs_of(spark, ODD), tokenizer_path()).collect()}
    for k, text in enumerate(ODD):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (list(got[k].ids), got[k].decoded) == (ids, decoded)
        assert digests[k].n_tokens == len(ids)
        assert digests[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[k].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_cuts_are_certain():
    coder = bpe.Bpe(bpe.read_spec(tokenizer_path()), cache_entries=3)
    tokens = [t.removesuffix("</w>") for t in coder.vocab]
    for word in ("xqzjvkq", "straßenbahn", "thanedble"):
        shown = "".join(coder.letters[b] for b in word.encode())
        cuts = coder.fragments(shown)
        assert "".join(cuts) == shown
        for a, b in itertools.pairwise(cuts):
            assert not any(a[-1] + b[0] in t for t in tokens)
    assert coder.encode("a b c d e a b") == bpe.Bpe(coder.spec).encode("a b c d e a b")


def test_bpe_of_no_rows(spark):
    assert bpe.encode_documents(docs_of(spark, []), tokenizer_path()).count() == 0


def exact_truth(texts):
    groups = {}
    for k, t in enumerate(texts):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(k)
    return {k: (g[0], len(g), k == g[0], hashlib.sha256(body.encode()).hexdigest()) for body, g in groups.items() for k in g}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    texts = ["a b", "a  b", None, "", "a\tb", " ", "c", "d", "dd", "a\xa0b", "e " * 4000, "e  " * 4000] + ["hot one"] * 300
    digest = (lambda c: F.length(c).cast("string")) if weak else exact_dedup.sha256
    got = exact_dedup.exact_groups(docs_of(spark, texts).repartition(7), salts=3, digest=digest).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == exact_truth(texts)
    assert len(got) == len(texts)


def test_exact_with_null_ids_and_repeated_rows(spark):
    rows = spark.createDataFrame([(None, "x"), (5, "x"), (5, "x"), (7, "y"), (None, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(rows).collect()), key=str)
    assert got == sorted([(None, 5, 3, False), (5, 5, 3, True), (5, 5, 3, True), (7, 7, 1, True), (None, None, 1, True)], key=str)
    assert exact_dedup.exact_groups(rows.limit(0)).count() == 0
    kept = exact_dedup.drop_copies(rows)
    assert kept.columns == rows.columns and sorted(map(tuple, kept.collect()), key=str) == [(5, "x"), (7, "y"), (None, "z")]


def plain_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_corpus():
    rng = random.Random(5)
    words = ["w%d" % k for k in range(400)]
    texts = [None, "", " \n", "One", "one two three", "ÄB c D e", "x" * 3000]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([30, 120, 200]))]
        for _ in range(rng.choice([1, 6, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts


def components_truth(fps, radius=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(k) for k in range(len(fps))]


@pytest.mark.parametrize("bucket", [4096, 3])
def test_near_groups(spark, bucket):
    texts = near_corpus()
    fps = [plain_fingerprint(t) for t in texts]
    truth = components_truth(fps)
    got = {r.doc_id: r for r in simhash_dedup.near_groups(docs_of(spark, texts).repartition(5), bucket=bucket).collect()}
    assert [got[k].fingerprint for k in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[k].component_id for k in range(len(texts))] == truth
    assert max(truth.count(t) for t in set(truth)) > 10


def test_near_groups_of_no_rows_and_null_ids(spark):
    assert simhash_dedup.near_groups(docs_of(spark, [])).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e")], "doc_id long, text string")
    assert {r.component_id for r in simhash_dedup.near_groups(rows).collect()} == {3}


def test_covering_masks_cover():
    masks = [m & (1 << 64) - 1 for m in simhash_dedup.covering_masks(3)]
    for bits in itertools.islice(itertools.combinations(range(64), 3), 0, None, 7):
        flipped = sum(1 << b for b in bits)
        assert any(not m & flipped for m in masks)


def test_connected_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 180)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 180)}, 300: 300, 301: 300}


def test_fingerprints(spark):
    texts = [t for t in near_corpus()]
    n = len(texts)
    ids = [k * 25 - 100 for k in range(n)]
    rows = spark.createDataFrame([(i, t, "en") for i, t in zip(ids, texts)], "doc_id long, text string, fp string")
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(rows.repartition(3)).collect()}
    assert len(got) == n
    fps = {i: int(got[i].fingerprint, 16) for i in ids}
    for k, i in enumerate(ids):
        text, following = texts[k] or "", texts[k - 1] or ""  # descending ids; the last one's next is the first
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        like = lambda a, b: 1 - (a ^ b).bit_count() / 64
        assert got[i].near_edited == like(fps[i], int(got[i].edited_fingerprint, 16))
        assert got[i].near_next == like(fps[i], fps[ids[k - 1]])
        if i % 50 == 0:
            assert got[i].near_rows == sum((fps[i] ^ f).bit_count() <= 3 for j, f in fps.items() if j != i)
        else:
            assert got[i].near_rows is None
    equal = {}
    for k, i in enumerate(ids):
        assert equal.setdefault(texts[k] or "", fps[i]) == fps[i]


def test_fingerprints_of_one_row_and_none(spark):
    one = spark.createDataFrame([(9, "some words here to see")], "doc_id long, text string")
    assert fingerprints.fingerprint_documents(one).first().near_next == 1.0
    assert fingerprints.fingerprint_documents(one.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (None, None), (4, "c d"), (4, "c d")], "doc_id long, text string")
    assert fingerprints.fingerprint_documents(odd).count() == 4


def plain_form(line):
    return " ".join(re.findall(r"[^\W_]+", line.lower()))


def line_form(line):
    return re.sub(r"[\x00-\x1f!-/:-@\[-`{-\x7f]+", "", line.lower()).strip(" ")


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_corpus():
    rng = random.Random(11)
    words = ["term%d" % k for k in range(300)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 90]))) for _ in range(25)]
    texts = [None, "", "\n\n", "---\n***\n---", "Same line here!\nsame   line, here"]
    for _ in range(60):
        picked = []
        for _ in range(rng.randrange(1, 6)):
            line = rng.choice(lines).split()
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(words)
            picked.append(" ".join(line))
        texts.append("\n".join(picked))
    return texts


@pytest.mark.parametrize("direct", [64, 2])
def test_line_dedup(spark, monkeypatch, direct):
    monkeypatch.setattr(line_dedup, "DIRECT", direct)
    texts = line_corpus()
    rows = docs_of(spark, texts)
    found = line_dedup.occurrences(rows, "doc_id", "text")
    fps = {(r.h1, r.h2): r.fp & (1 << 64) - 1 for r in line_dedup.line_fingerprints(found).collect()}
    bodies = {(r.h1, r.h2): r.body for r in found.collect()}
    assert set(bodies.values()) == {line_form(x) for t in texts for x in (t or "").split("\n")} - {""}
    keys = sorted(bodies)
    group = {k: k for k in keys}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    links = 0
    for a, b in itertools.combinations(keys, 2):
        x, y = bodies[a].split(), bodies[b].split()
        if (fps[a] ^ fps[b]).bit_count() <= 3 and word_edits(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
            group[find(a)] = find(b)
            links += 1
    assert links > 20
    of_body = {bodies[k]: find(k) for k in keys}
    seen, expected = set(), []
    for k, t in enumerate(texts):
        kept = []
        for line in (t or "").split("\n"):
            g = of_body.get(line_form(line))
            if g is None or g not in seen:
                kept.append(line)
            seen.add(g)
        seen.discard(None)
        expected.append((k, len((t or "").split("\n")), len(kept), "\n".join(kept)))
    got = sorted((r.doc_id, r.n_lines, r.n_kept, r.text) for r in line_dedup.dedup_lines(rows).collect())
    assert got == expected


def test_line_dedup_of_no_rows_and_null_ids(spark):
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0
    rows = spark.createDataFrame([(None, "one line of text\nother"), (2, "one line of text")], "doc_id long, text string")
    assert sorted(r.text for r in line_dedup.dedup_lines(rows).collect()) == ["one line of text", "other"]


def test_license_scan(spark):
    t = license_scan.TEMPLATES
    texts = [
        None, "", "nothing here at all", t["MIT"], "intro words\n  RELEASED under the mit license!!\nend", t["GPL-3.0"].replace("version 3", "version 2"), t["MIT-text"].replace(", ", ",\n"),
        "\n".join([t["Apache-2.0"], t["MIT"], t["MIT"]]), "x" * 9000, "licensed under the",
    ]
    grams = {k: set(itertools.pairwise(plain_form(v).split())) for k, v in t.items()}
    got = {r.doc_id: r for r in license_scan.scan_documents(docs_of(spark, texts)).collect()}
    for k, text in enumerate(texts):
        units = list(enumerate((text or "").split("\n"))) + ([(-1, text)] if text and "\n" in text else [])
        hits = []
        for pos, unit in units:
            mine = set(itertools.pairwise(plain_form(unit).split()))
            for name, theirs in grams.items():
                dice = 2 * len(mine & theirs) / (len(mine) + len(theirs)) if mine else 0
                if dice >= 0.8 - 1e-9:
                    hits.append((-dice, name, pos))
        best = min(hits, default=None)
        assert got[k].n_matches == len({h[2] for h in hits})
        assert got[k].licenses == ",".join(sorted({h[1] for h in hits}))
        assert (got[k].best_license, got[k].best_line) == ((best[1], best[2]) if best else (None, None))
    assert got[6].best_license == "MIT-text" and got[6].best_line == -1
    assert license_scan.scan_documents(docs_of(spark, [])).count() == 0
    assert license_scan.scan_documents(docs_of(spark, ["a b c"]), {"one": "word"}).first().n_matches == 0


def test_chat_rotation(spark):
    rows = [(1, k, ["ann", "bob", None][k % 3], None if k == 4 else f"text {k}", "x") for k in range(10)] + [(1, 3, "ann", "text 3", "x"), (2, None, "ann", "late", "x"), (2, 1, "bob", "é" * 3000, "x"), (None, 0, "ann", "a", "x")]
    table = spark.createDataFrame([*rows, rows[0]], "conv_id long, turn long, role string, text string, perspective string")
    got = chat.rotate(table, segment=4).collect()
    whole = {}
    for r in sorted(got, key=lambda r: (str(r.conv_id), r.perspective, r.segment)):
        text, mask = whole.get((r.conv_id, r.perspective), ("", ""))
        assert r.start == len(text) and len(r.rendered) == len(r.mask)
        whole[r.conv_id, r.perspective] = (text + r.rendered, mask + r.mask)
    for conv in (1, 2, None):
        turns = sorted({(1 << 62 if t is None else t, s or "unknown", x or "") for c, t, s, x, _ in rows if c == conv})
        for me in {s for _, s, _ in turns}:
            text = mask = ""
            for _, s, x in turns:
                head = "<|im_start|>assistant\n" if s == me else f"<|im_start|>user name={s}\n"
                text += head + x + "<|im_end|>\n"
                mask += "0" * len(head) + ("1" if s == me else "0") * (len(x) + 10) + "0"
            assert whole.pop((conv, me)) == (text, mask)
    assert not whole
    assert chat.rotate(table.limit(0)).count() == 0
