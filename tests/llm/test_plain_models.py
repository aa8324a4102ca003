"""The classifiers and the fingerprints' votes worked out again in plain Python: features, loss, fit, cells, shrinkage and odds."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash

from recordwatch.llm import fingerprints, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def sigmoid(z):
    return 1 / (1 + math.exp(-min(40.0, max(-40.0, z))))


def plain_fit(rows, labels, n_features, pairs=(), pair_weight=0.0, l2=1e-3, rate=0.05, rounds=300):
    """Mean log loss, l2/2 |w|^2 and the mean squared change over the pairs, by Adam."""
    n, start = len(rows), (sum(labels) + 0.1) / (len(rows) + 2)
    theta = [0.0] * n_features + [math.log(start / (1 - start))]
    m, v = [0.0] * len(theta), [0.0] * len(theta)
    for k in range(1, rounds + 1):
        grad = [l2 * w for w in theta[:-1]] + [0.0]
        for row, y in zip(rows, labels):
            error = (sigmoid(sum(theta[f] for f in row) + theta[-1]) - y) / n
            for f in (*row, -1):
                grad[f] += error
        for gained, lost in pairs:
            shift = sum(theta[f] for f in gained) - sum(theta[f] for f in lost)
            for sign, side in ((1, gained), (-1, lost)):
                for f in side:
                    grad[f] += pair_weight * 2 * shift * sign / len(pairs)
        for f, g in enumerate(grad):
            m[f], v[f] = 0.9 * m[f] + 0.1 * g, 0.99 * v[f] + 0.01 * g * g
            theta[f] -= rate * (m[f] / (1 - 0.9**k)) / (math.sqrt(v[f] / (1 - 0.99**k)) + 1e-8)
    return theta[:-1], theta[-1]


def texts_and_labels():
    rng = random.Random(12)
    plain, bad, names = ["garden", "river", "stone", "window", "letters", "evening", "quiet", "bread"], ["vermin", "vermins", "scumbag"], ["women", "men", "muslim", "jewish", "old"]
    rows, labels = [], []
    for k in range(160):
        words = rng.choices(plain, k=rng.randint(2, 14))
        toxic, poor = rng.random() < 0.3, rng.random() < 0.35
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        if rng.random() < (0.6 if toxic else 0.2):
            words.append(rng.choice(names))
        text = " ".join(words).capitalize() + rng.choice([".", "!", ""])
        text = " ".join(f"{w}|{rng.randint(0, 99)} $" for w in words) + "\n" * 2 if poor else text
        rows.append((k, text, f"host{k % 5}", rng.choice(["a", "b", None])))
        labels.append((k, int(not poor), int(toxic)) if k % 9 else (k, None, None))
    return rows + [(900, None, None, "a"), (901, "", "host0", "a")], labels


def features(text):
    words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    return words, words | {w[:k] + "*" for w in words for k in (4, 5, 6) if len(w) > k}


def test_toxicity_scores(spark):
    rows, labels = texts_and_labels()
    text_of = {r[0]: r[1] for r in rows}
    known = [(i, t) for i, _, t in labels if t is not None and not held_out(i)]
    counts, total = {0: Counter(), 1: Counter()}, Counter(t for _, t in known)
    for i, t in known:
        counts[t].update(features(text_of[i])[1])
    z = {}
    for f in {*counts[0], *counts[1]}:
        a, b = counts[1][f], counts[0][f]
        if a + b >= toxicity.LEAST_TEXTS:
            odds = math.log((a + 0.5) / (total[1] - a + 0.5)) - math.log((b + 0.5) / (total[0] - b + 0.5))
            z[f] = abs(odds) / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    names = {t for kind in toxicity.IDENTITY_TERMS.values() for t in kind}
    chosen = sorted(names | set(sorted((f for f in z if z[f] >= toxicity.LEAST_Z), key=lambda f: (-z[f], f))[: toxicity.FEATURES]))
    at = {f: k for k, f in enumerate(chosen)}
    has, pairs = [], []
    for i, t in known:
        words, own = features(text_of[i])
        has.append([at[f] for f in own if f in at])
        for kind in toxicity.IDENTITY_TERMS.values():
            for name in words & set(kind):
                for other in set(kind) - {name}:
                    after = features(" ".join(words - {name} | {other}))[1]
                    pairs.append(([at[f] for f in after - own if f in at], [at[f] for f in own - after if f in at]))
    assert pairs and any("vermin" in f for f in chosen)
    weights, bias = plain_fit(has, [t for _, t in known], len(chosen), pairs, toxicity.PAIR_WEIGHT)
    got = toxicity.score_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = sigmoid(bias + sum(weights[at[f]] for f in features(text_of[r.doc_id])[1] if f in at))
        assert abs(r.score - expected) < 1e-6 and r.predicted == int(expected >= 0.3) and r.held_out == held_out(r.doc_id)
    flagged = {r.doc_id for r in got if r.predicted}
    assert len(flagged & {i for i, _, t in labels if t}) > 0.8 * sum(t == 1 for _, _, t in labels)


def plain_measures(text):
    words, lines, marks = text.split(), text.split("\n"), "#$%&*+<=>@\\^_`{|}~"
    n, k = max(1, len(text)), max(1, len(words))
    often = max((words.count(w) for w in words), default=0)
    share = lambda xs: sum(1 for _ in xs) / k
    return [
        len(words), sum(len(w) for w in words) / k, max((len(w) for w in words), default=0) / 10, share(w for w in words if w.isupper()), share(c for c in text if c in marks), share(c for c in text if c == "|"), share(c for c in text if c == "!"),
        share(c for c in text if c in ".?"), share(c for c in text if c == ","), sum(c in "0123456789" for c in text) / n, len(lines) / k, 1 - len(set(lines)) / len(lines), len(set(words)) / k, often / k, share(w for w in words if len(w) == 1),
        share(w for w in words if w[-1] in marks), len(re.findall("http", text)) / k, share(w for w in words if w[0].isupper()),
    ]


def quantile(values, q):
    values, place = sorted(values), q * (len(values) - 1)
    low = math.floor(place)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)


def strength(groups, mean):
    """``groups``: (n, share of good, prior)."""
    n, chance = sum(g[0] for g in groups), mean * (1 - mean)
    between = (sum(g[0] * (g[1] - g[2]) ** 2 for g in groups) - (len(groups) - 1) * chance) / n
    return min(1e6, max(2.0, chance / between - 1 if between > 0 else 1e6))


def test_quality_scores(spark):
    rows, labels = texts_and_labels()
    seen = {i: plain_measures(t or "") for i, t, _, _ in rows}
    known = [(i, q) for i, q, _ in labels if q is not None and not held_out(i)]
    columns = list(zip(*(seen[i] for i, _ in known)))
    # Edges that are the same but for rounding count as one, as equal quantiles do there.
    edges = [sorted({quantile(c, k / quality.CELLS) for k in range(1, quality.CELLS)}) for c in columns]
    cells = lambda i: [sum(e <= x + 1e-12 for e in own) + k * quality.CELLS for k, (x, own) in enumerate(zip(seen[i], edges))]
    weights, bias = plain_fit([cells(i) for i, _ in known], [q for _, q in known], quality.CELLS * len(edges), rate=0.1)
    p = {i: min(999_999, max(1, round(sigmoid(bias + sum(weights[c] for c in cells(i))) * 1e6))) / 1e6 for i in seen}
    got = {r.doc_id: r for r in quality.score_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    off = [abs(got[i].evidence - p[i]) for i in p]
    assert sum(x > 0.02 for x in off) <= 0.03 * len(off) and sorted(off)[len(off) // 2] < 1e-3
    # The hierarchy, from the evidence as it is.
    p = {i: r.evidence for i, r in got.items()}
    paths, hosts = defaultdict(list), defaultdict(list)
    for i, _, host, path in rows:
        paths[host, path].append(p[i])
        hosts[host].append(p[i])
    mean = sum(p.values()) / len(p)
    share = lambda xs: sum(xs) / len(xs)
    k = strength([(len(x), share(x), mean) for x in hosts.values()], mean)
    of_host = {h: (sum(x) + k * mean) / (len(x) + k) for h, x in hosts.items()}
    k = strength([(len(x), share(x), of_host[h]) for (h, _), x in paths.items()], mean)
    of_path = {hp: (sum(x) + k * of_host[hp[0]]) / (len(x) + k) for hp, x in paths.items()}
    odds = lambda x: x / (1 - x)
    for i, _, host, path in rows:
        z = odds(p[i]) * odds(of_path[host, path]) / odds(mean)
        r = got[i]
        assert abs(r.host_posterior - of_host[host]) < 1e-5 and abs(r.path_posterior - of_path[host, path]) < 1e-5 and abs(r.score - z / (1 + z)) < 1e-4
        assert r.kept == (r.score >= quality.KEEP_FROM)
    right = [r.kept == bool(q) for i, q, _ in labels if q is not None for r in [got[i]]]
    assert sum(right) > 0.9 * len(right)


def test_votes_of_fingerprints(spark):
    rng = random.Random(2)
    texts = ["", "One", "one ONE one", "Äpfel und\tBirnen  ÄPFEL"] + [" ".join(rng.choice(["a", "bb", "long-word", "middle", "ÉTÉ", "\U0001f600"]) for _ in range(rng.randint(2, 60))) for _ in range(40)]

    def votes(text):
        words = re.sub(r"[\x20\x09-\x0D]+", " ", text.lower()).split(" ")
        words = [w for w in words if w]
        up, whole = [0] * 64, 0
        for k, word in enumerate(words):
            h, letters = xxhash.xxh64_intdigest(word.encode(), 42), len(word)
            if k + 1 < len(words):
                h, letters = xxhash.xxh64_intdigest(words[k + 1].encode(), h), letters + len(words[k + 1])
            weight = 2 ** min(3, letters // 4)
            whole += weight
            for bit in range(64):
                up[bit] += weight * (h >> bit & 1)
        return sum((2 * n > whole) << bit for bit, n in enumerate(up))

    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(rows).collect()}
    for k, text in enumerate(texts):
        third = len(text) // 3
        edited = text[: len(text) - third] + texts[k - 1][:third]
        assert (got[k].fingerprint, got[k].edited_fingerprint) == (f"{votes(text):016x}", f"{votes(edited):016x}")
