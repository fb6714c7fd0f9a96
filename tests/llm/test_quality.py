import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, source string, kept string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), len(lines)


def failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def vector(c):
    n, chars, symbols, dups, again, lines = c
    values = [n, chars / max(n, 1), 100 * symbols / max(chars, 1), 100 * dups / max(lines, 1), 100 * again / max(n, 1)]
    return [math.floor(math.log1p(v) * Q.SCALE + 0.5) / Q.SCALE for v in values]


def exact_percentile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo = math.floor(at)
    return values[lo] + (at - lo) * (values[min(lo + 1, len(values) - 1)] - values[lo])


def hashes(spark, rows, starts):
    """What a row's hash is, per start but the first."""
    docs = spark.createDataFrame([(n, *r[:4]) for n, r in enumerate(rows)], "n int, doc_id long, text string, lang string, source string")
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")), "lang", "source")
    found = docs.select("n", *[F.xxhash64(F.lit(k), "doc_id", key).alias(f"h{k}") for k in range(1, starts)]).orderBy("n").collect()
    return [[r[f"h{k}"] for r in found] for k in range(1, starts)]


def strict(spark, rows, wider=True):
    """What the op9 query and the pipeline judge by."""
    return verdicts(rows, steps=None, minima=Q.MINIMA, tail=Q.FALSE_REJECTIONS, few=hashes(spark, rows, Q.STRICT["starts"]), wider=wider)


def verdicts(rows, support=0.75, steps=3, least_rows=50, tail=1e-9, minima=None, few=None, wider=False):
    """Concentration steps with numpy, group by group. few: per start but the first, what a row's hash is."""
    stats = [counts(t) for _, t, *_ in rows]
    groups, kept = defaultdict(list), [not failed(c) for c in stats]
    for i, (_, _, lang, source, *_) in enumerate(rows):
        if kept[i]:
            groups[lang, source].append(i)
    floors = np.array(list((minima or Q.FLOORS).values()))
    cell = lambda d: math.floor(math.log2(1 + min(d, 1e15)) * Q.SCALE)

    def floored(cov):
        return cov - np.diag(np.diag(cov)) + np.diag(np.maximum(np.diag(cov), floors**2)) if minima else cov + np.diag(floors**2)

    def of(x):
        return x.mean(axis=0), floored(np.cov(x.T, bias=True))

    def distances(x, mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    def step(x, mean, cov):
        cells = [cell(v) for v in distances(x, mean, cov)]
        return of(x[np.array(cells) <= exact_percentile(cells, support)])

    log_det = lambda e: np.linalg.slogdet(e[1])[1]
    pools = [(ids, ids) for ids in groups.values() if len(ids) >= least_rows]
    if wider:
        langs, small = defaultdict(list), defaultdict(list)
        for (lang, _), ids in groups.items():
            langs[lang] += ids
            small[lang] += ids if len(ids) < least_rows else []
        pools += [(langs[lang], ids) for lang, ids in small.items() if ids and len(langs[lang]) >= least_rows]
        rare = [i for lang, ids in small.items() if len(langs[lang]) < least_rows for i in ids]
        pools += [([i for ids in langs.values() for i in ids], rare)] if rare else []
    for ids, judged in pools:
        x = np.array([vector(stats[i]) for i in ids])
        mean = np.array([exact_percentile(x[:, j] * Q.SCALE, 0.5) for j in range(5)]) / Q.SCALE
        mad = np.array([exact_percentile(abs(x[:, j] - mean[j]) * Q.SCALE, 0.5) for j in range(5)]) / Q.SCALE
        found = [(mean, floored(np.diag((1.4826 * mad) ** 2)))]
        for hashes in few or []:
            taken = [n for n, i in enumerate(ids) if hashes[i] % len(ids) < Q.FEW]
            found += [of(x[taken])] if taken else []
        for _ in range(2 if steps is None else steps):
            found = [step(x, *e) for e in found]
        best = min(found, key=log_det)
        while steps is None:
            after = step(x, *best)
            if log_det(after) >= log_det(best) - 1e-9:
                break
            best = after
        d = distances(x, *best)
        middle = 2 ** ((exact_percentile([cell(v) for v in d], 0.5) + 0.5) / Q.SCALE) - 1
        half = Q.chi_square_quantile(0.5, 5)
        for i, v in zip(ids, d * half / max(middle, half), strict=True):
            if i in judged:
                kept[i] = v <= Q.chi_square_quantile(1 - tail, 5)
    return stats, kept


def corpus(seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(400):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(int(r.lognormvariate(5, 0.8)) + 1)]
        if i % 20 == 0:
            words = [w + "###" * 3 for w in words]
        if i % 33 == 0:
            words = words[:4] * 30
        if i % 41 == 0:
            words = ["\n", *words[:10], "\n", *words[:10], "\n", *words]
        rows.append((i, " ".join(words), r.choice(["en", "de", None]), r.choice(["a", "a", None]), "x", 1))
    return [*rows, rows[7], (900, None, None, None, "", 0), (901, "", "en", "a", "", 0), (902, "w " * 70_000, "en", "b", "", 0),
        (None, "one two", "en", "a", "", 0)]


def test_against_brute_force(spark):
    rows = corpus()
    stats, kept = verdicts(rows)
    plain = {"steps": 3, "minima": None, "tail": 1e-9, "wider": False, "starts": 1}
    found = Q.quality(spark.createDataFrame(rows, SCHEMA).repartition(4), **plain).collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"],
        r["kept"]) for r in found)
    assert got == Counter((row[0], *c[:5], failed(c), k) for row, c, k in zip(rows, stats, kept, strict=True))
    assert sum(not k and not failed(c) for c, k in zip(stats, kept, strict=True)) > 10  # the method rejects some itself


def test_strict_rules_against_brute_force(spark):
    """Several starts, steps to convergence, floors as minima, small groups by wider ones."""
    rows = corpus(5) + [(2000 + i, f"{' '.join('abcdefgh'[i % 8] * (1 + k % 7) + str(k * i % 91) for k in range(60 + i))}", "fr", f"s{i}", "",
        0) for i in range(9)]
    for wider in (False, True):
        stats, kept = strict(spark, rows, wider)
        found = Q.quality(spark.createDataFrame(rows, SCHEMA).repartition(3), **{**Q.STRICT, "wider": wider}).collect()
        assert Counter((r["doc_id"], r["n_words"], r["kept"]) for r in found) == Counter((row[0], c[0], k) for row, c, k in zip(rows, stats, kept, strict=True))


def test_keeping_and_empty(spark):
    rows = corpus(2)
    docs = spark.createDataFrame(rows, SCHEMA)
    _, kept = verdicts(rows)
    stay = Q.keep_good(docs, steps=3, minima=None, tail=1e-9, wider=False, starts=1)
    assert stay.columns == docs.columns and Counter(r["doc_id"] for r in stay.collect()) == Counter(row[0] for row, k in zip(rows, kept, strict=True) if k)
    assert Q.quality(docs.limit(0)).count() == 0


def test_each_coordinate_alone_rejects(spark):
    """A clean group and one extreme document a coordinate."""
    r = random.Random(3)
    word = lambda n=None: "".join(r.choice("abcdefghijklmnop") for _ in range(n or r.randint(3, 8)))
    line = lambda n=12: " ".join(word() for _ in range(n))
    clean = ["\n".join(line() for _ in range(r.randint(10, 25))) for _ in range(200)]
    twice = [line(2) for _ in range(4)]  # short lines, so few words repeat
    odd = {
        "words": "\n".join(line() for _ in range(2000)),
        "word_length": "\n".join(" ".join(word(30) for _ in range(12)) for _ in range(15)),
        "symbols": "\n".join(line() + " | | | |" for _ in range(15)),
        "dup_lines": "\n".join([*(twice * 5), *(line(30) for _ in range(8))]),
        "repeats": "\n".join([*(line() for _ in range(9)), *(" ".join(["a b c d e f g h"] * 3) + f" {k}" for k in range(4))]),
    }
    assert not any(failed(counts(t)) for t in odd.values())
    rows = [(i, t, "en", "a", "", 0) for i, t in enumerate([*clean, *odd.values()])]
    kept = {x["doc_id"]: x["kept"] for x in Q.quality(spark.createDataFrame(rows, SCHEMA), **Q.STRICT).collect()}
    assert not any(kept[200 + k] for k in range(len(odd))), {n: kept[200 + k] for k, n in enumerate(odd)}
    assert sum(kept[i] for i in range(200)) >= 196
    largest = {"log_symbols": math.log1p(100), "log_dup_lines": math.log1p(100), "log_repeats": math.log1p(50)}
    assert all((v / Q.MINIMA[n]) ** 2 > Q.chi_square_quantile(1 - Q.FALSE_REJECTIONS, 5) for n, v in largest.items())


def test_small_groups_are_judged_by_wider_ones(spark):
    r = random.Random(4)
    text = lambda extra="": "\n".join(" ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8))) for _ in range(12)) + extra for _ in range(r.randint(8, 20)))
    junk = " | | | | |"
    rows = [(i, text(), "en", f"site{i % 20}", "", 0) for i in range(80)]  # 4 rows a source
    rows += [(100, text(junk), "en", "site3", "", 0), (101, text(), "xx", "rare", "", 0), (102, text(junk), "xx", "rare", "", 0),
        (103, text(junk), None, None, "", 0), (104, None, "en", "none", "", 0)]
    rows += [(200 + i, text(), "de", "big", "", 0) for i in range(60)] + [(300, text(junk), "de", "big", "", 0)]
    found = {x["doc_id"]: x for x in Q.quality(spark.createDataFrame(rows, SCHEMA), **Q.STRICT).collect()}
    assert len(found) == len(rows) and not any(found[i]["kept"] for i in (100, 102, 103, 104, 300))
    assert found[101]["kept"] and sum(found[i]["kept"] for i in range(80)) >= 78
    assert all(x["base_failed"] or x["distance"] is not None for x in found.values())
