import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strata.llm import licences, line_dedup, pii
from strata.llm.licence_texts import BOILERPLATE

SCHEMA = "doc_id long, text string, lang string, source string, spans string, start int"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15
            if ok:
                out.append((k, m.start(), m.end()))
    return out


TEXTS = [
    None, "", "mail a.b+c@x-y.example.com, a@b no, x@y@z.com and a@b.c%d@e.f",
    "ip 10.0.0.1 and 256.1.1.1 1.2.3.4.5.6.7.8 010.0000255.3.4 99999999999999999999.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 and 1 2 3",
    "call +1 (523) 555-1055 or +49.30.1234567 or +1 2 or ++12345678 é🎉+44 20 7946 0958.",
    "é🎉 4111 1111 1111 1111+1 (523) 555-1055x@y.zz 1.2.3.4", "9" * 3000 + " " + "a" * 3000 + "@ " + "1." * 500 + " " + "+1" + "(" * 2000, "a@b.c" * 50,
    "-4111-1111-1111-1111- +1-(2)-3-4-5-6-7-8",
]


SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|private[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_./+=-]{16,})")


def secrets(text):
    return [(6, m.start(1), m.end(1)) for m in SECRET.finditer(text or "")]


def test_base_spans(spark):
    r = random.Random(8)
    odd = ["".join(r.choice("+1234567890 -.()@ax") if r.random() < 0.9 else r.choice(["4111111111111111", "\n", "é", "10.0.0.1"]) for _ in range(r.randint(20,
        120))) for _ in range(400)]
    runs = ["".join(r.choice(["1", "22", " ", "-", "  ", "+", "4242424242424242", "378282246310005"]) for _ in range(30)) for _ in range(300)]
    rows = [(i, t, "en", "a", "", 0) for i, t in enumerate(TEXTS + odd + runs)] + [(None, TEXTS[2], "", "", "", 0), (2, TEXTS[2], "", "", "", 0),
        (5000, 'token = "24be64439e3e49cf46b2"\nPASSWORD:abc', "", "", "", 0)]
    found = pii.personal_data(spark.createDataFrame(rows, SCHEMA).repartition(3), support=10**6).collect()
    got = sorted((str(r["doc_id"]), [tuple(s)[:3] for s in r["spans"]]) for r in found)
    assert got == sorted((str(i), sorted(base(t) + secrets(t))) for i, t, *_ in rows)
    assert sum(k == 2 for _, t, *_ in rows for k, *_ in base(t)) > 20 and sum(k == 3 for _, t, *_ in rows for k, *_ in base(t)) > 20
    assert pii.personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


TERM = re.compile(r"(?<![^\s\"'(\[])[^\W\d_]{3,}(?![^\s.,;:!?\"')\]])(?![^\W\d_])")


def telling(rows, support=1, generalise=0.7, remove=0.9):
    """Spans of terms, and the pairs with their counts, by plain counting over lines."""
    n_c, n_t, n_ct, of, total = Counter(), Counter(), Counter(), defaultdict(set), 0
    for i, text, *_ in rows:
        at = 0
        for line in (text or "").split("\n"):
            terms = {m[0].lower() for m in TERM.finditer(line)}
            total += bool(terms)
            n_t.update(terms)
            here = {(k, re.sub("[^0-9]", "", text[a:b]) if k in (2,
                3) else text[a:b] if k == 6 else text[a:b].lower()) for k, a, b in base(text) + secrets(text) if at <= a < at + len(line)}
            n_c.update(here)
            n_ct.update((c, t) for c in here for t in terms)
            of[i, text] |= {(c, t) for c in here for t in terms}
            at += len(line) + 1
    share = lambda c, t: math.log2(n_ct[c, t] * total / (n_c[c] * n_t[t])) / math.log2(total / n_c[c])
    out = {}
    for i, text, *_ in rows:
        action = {}
        for c, t in of[i, text]:
            if n_ct[c, t] >= support and (s := share(c, t)) >= generalise:
                action[t] = max(action.get(t, 0), 5 if s >= remove else 4)
        out[i] = sorted((action[m[0].lower()], m.start(), m.end()) for m in TERM.finditer(text or "") if m[0].lower() in action)
    return out, (n_c, n_t, n_ct, total)


def secret_corpus():
    filler = "some plain words of the corpus that say nothing at all about anyone here "
    rows = [(i, filler * (1 + i % 3) + f"\n{filler}", "en", "a", "", 0) for i in range(60)]
    rows += [(100 + i, f"{filler}\nthe Zanzibar office of Quibble asks kate@corp.example.com for plain answers in 2023 card 4111 1111 1111 1111. {filler}\nZanzibar again", "en", "a", "", 0) for i in range(4)]
    rows += [(200, "Write to bob@x.example.com about Unicorns and words.", "en", "a", "", 0), (201, f"{filler} Quibble {filler}", "en", "a", "", 0),
        (202, "call +1 (523) 555-1055, Kate, or kate@corp.example.com Zanzibar", "", "", "", 0)]
    rows += [(300 + i, f"{word} {filler}", "en", "a", "", 0) for i, word in enumerate(["unicycle", "unison", "unicorn", "unicorns", "quilt"] * 3)]
    return rows


def test_terms_that_disclose(spark):
    rows = secret_corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want, _ = telling(rows)
    found = {r["doc_id"]: [tuple(s)[:3] for s in r["spans"]] for r in pii.personal_data(docs).collect()}
    assert found == {i: sorted(base(t)) + want.get(i, []) for i, t, *_ in rows}
    words = [t[a:b] for i, t, *_ in rows for _, a, b in want.get(i, [])]
    # Near a match of another kind as well, wherever in the text, and beside a value that occurs once.
    assert words.count("Zanzibar") == 9 and "Quibble" in words and "Unicorns" in words and not {"plain", "words"} & set(words)
    assert all(not found[i] for i in range(60)) and not found[201]
    few = {r["doc_id"]: [tuple(s)[:3] for s in r["spans"]] for r in pii.personal_data(docs, support=2).collect()}
    assert few == {i: sorted(base(t)) + telling(rows, support=2)[0].get(i, []) for i, t, *_ in rows}


def test_sanitised_texts(spark):
    rows = secret_corpus()
    out = pii.sanitised(spark.createDataFrame([*rows, rows[70]], SCHEMA))
    assert out.columns == ["doc_id", "text", "lang", "source", "spans", "start", "sanitised"] and out.count() == len(rows) + 1
    out = pii.sanitised(spark.createDataFrame(rows, SCHEMA), generalise=0.5)
    texts = {r["doc_id"]: r["sanitised"] for r in out.collect()}
    assert texts[3] == next(t for i, t, *_ in rows if i == 3) and "kate@" not in texts[100] and "<CARD>" in texts[100]
    spans, (n_c, n_t, n_ct, total) = telling(rows, generalise=0.5)
    text = next(t for i, t, *_ in rows if i == 200)
    for kind, a, b in spans[200]:
        term, c = text[a:b], (0, "bob@x.example.com")
        weak = lambda p: math.log2(n_ct[c,
            term.lower()] * total / (n_c[c] * sum(n for w, n in n_t.items() if w.startswith(p)))) / math.log2(total / n_c[c]) < 0.5
        begin = max((k for k in range(1, len(term)) if weak(term[:k].lower())), default=0)
        assert ("<REMOVED>" if kind == 5 else term[:begin] + "*" if begin else "<WORD>") in texts[200]
    assert any(k == 4 for k, *_ in spans[200]) and "<EMAIL> about Uni* " in texts[200]


def test_lines(spark):
    text = lambda i: "\n".join([f"own {i}", "everywhere", *(["often"] if i % 4 else []), *(["few"] if i < 8 else []), " everywhere ", "",
        f"last {i}"])
    rows = [(i, text(i), "en", f"site{i % 40}", "", 0) for i in range(120)] + [(500, None, "en", None, "", 0), (501, "", "", "", "", 0),
        (3, text(3), "en", "site3", "", 0), (None, "everywhere\n" * 3, "", None, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sites = defaultdict(set)
    for _, t, _, site, *_ in rows:
        for line in (t or "").split("\n"):
            sites[line.strip()].add(site)
    common = {x for x, s in sites.items() if x and len(s) >= 10}
    assert common == {"everywhere", "often"}
    found = line_dedup.marked_lines(docs).collect()
    want = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        gone = [k for k, x in enumerate(lines) if x.strip() in common]
        want.append((str(i), sum(bool(x.strip()) for x in lines), gone, sum(len(lines[k]) for k in gone)))
    assert sorted((str(r["doc_id"]), r["n_lines"], r["removed"], r["removed_chars"]) for r in found) == sorted(want)
    clean = {r["doc_id"]: r["text"] for r in line_dedup.without_boilerplate(docs).collect()}
    assert clean[1] == "own 1\nfew\n\nlast 1" and clean[500] is None and clean[501] == ""
    near = {r["hash"]: r["sites"] for r in line_dedup.boilerplate(line_dedup.site_lines(docs), least_sites=30).collect()}
    assert sorted(near.values()) == [30, 41]  # near the threshold counts are exact
    # What is clear of the threshold never comes to the exact count.
    spread = line_dedup.spread_of(line_dedup.site_lines(docs), least_sites=20)
    assert sorted(r["sites"] for r in spread.collect()) == [30, 41] and line_dedup.near_threshold(spread).count() == 0
    assert [r["sites"] for r in line_dedup.near_threshold(line_dedup.spread_of(line_dedup.site_lines(docs), least_sites=30)).collect()] == [30]
    assert line_dedup.marked_lines(docs.limit(0)).count() == 0


def plain_scan(rows, path, header=0.6, file=0.5):
    """Cosines of all lines and texts with all templates, and a walk up the directories."""
    lines = Counter(w for _, t, *_ in rows for x in (t or "").split("\n") for w in set(licences.tokens_of(x)))
    total = sum(bool(licences.tokens_of(x)) for _, t, *_ in rows for x in (t or "").split("\n"))
    idf = lambda w: math.log((1 + total) / (1 + lines[w])) + licences.LEAST
    vector = lambda words: {w: n * idf(w) for w, n in Counter(words).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = [(name, vector(licences.tokens_of(t))) for name, ts in licences.TEMPLATES.items() for t in ts]

    def best(said, least):
        v = vector(licences.tokens_of(said))
        found = [(name in BOILERPLATE, -round(sum(x * b.get(w, 0) for w, x in v.items()) / size(v) / size(b), 9), name) for name, b in templates] if v else []
        found = sorted(x for x in found if -x[1] >= least)
        return (*found[0], next((x[1] for x in found if x[2] != found[0][2]), 0.0) - found[0][1]) if found else None

    own, holders = [], defaultdict(list)
    for row in rows:
        text, where = row[1] or "", path(row)
        units = [(*x[:2], k, *x[2:]) for k, said in enumerate(text.split("\n")) if (x := best(said, header))] + [(*x[:2], -1, *x[2:]) for x in [best(text, file)] if x]
        top = min(units, default=None)
        last, top = (top[0], top[1:]) if top else (None, None)
        is_file = bool(top) and (top[1] < 0 or bool(re.search(licences.FILE_NAME, where)))
        own.append((where, top, is_file))
        if is_file:
            holders[where.rpartition("/")[0]].append((last, top[0], where, top[2]))
    out = []
    for row, (where, top, is_file) in zip(rows, own, strict=True):
        licence, source, d = top[2] if top else None, None, where.rpartition("/")[0]
        while not top:
            if d in holders:
                licence, source = min(holders[d])[3], d
                break
            if not d:
                break
            d = d.rpartition("/")[0]
        out.append((row[0], where, top[2] if top else None, -top[0] if top else None, top[1] if top else None, is_file, licence, source, top[3] if top else None))
    return out


def test_licences(spark):
    from strata.llm import licence_texts as L

    prose = "The quick brown fox is of the opinion that software is not for the lazy dog. " * 4
    rows = [(i, f"{prose}{i} {i * 7} x{i}\nnothing{i}", "en", "lib", "", 0) for i in range(30)]
    rows += [(100, f"Copyright (c) 2001 Kim Doe\n\n{L.MIT}", "README", "lib", "", 0),
        (101, f"// Licensed under the Apache License, Version 2.0.\n{prose}", "a.c", "lib/sub/deep", "", 0), (102, prose, "b.c", "lib/sub/deep", "", 0),
        (103, prose, "c.c", "other", "", 0)]
    rows += [(104, L.GPL_NOTICE, "COPYING", "lib/sub", "", 0), (105, None, None, None, "", 0), (106, "", "d.c", "lib/x", "", 0),
        (102, prose, "b.c", "lib/sub/deep", "", 0), (107, "This is licensed to be of the software in the form", "e.c", "other", "", 0)]
    rows += [(108, "see below\nReleased under the MIT License.", "LICENSE.md", "third", "", 0), (109, prose, "x/y/z.c", "third", "", 0),
        (110, "license license license license", "f.c", "third", "", 0), (111, L.BSD_3.replace("THE COPYRIGHT", "KIM DOE"), "LICENSE", "bsd", "", 0),
        (112, "word " * 60_000 + "MIT License", "big", "bsd", "", 0), (None, L.ISC, "LICENSE", "isc", "", 0),
        (113, L.MIT + "\n" + L.MIT, "twice", "two", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    path = lambda r: "/".join(x for x in (r[3], r[2]) if x is not None)
    want = plain_scan(rows, path)
    found = [tuple(r) for r in licences.scan(docs, F.concat_ws("/", "source", "lang")).collect()]
    near = lambda x: tuple(round(v, 6) if isinstance(v, float) else v for v in x)
    assert sorted(map(near, found), key=str) == sorted(map(near, want), key=str)
    by_id = {r[0]: r[2:] for r in want}
    assert by_id[100][0] == "MIT" and by_id[100][3] and by_id[101][0] == "Apache-2.0" and not by_id[101][3] and by_id[111][:1] == ("BSD-3-Clause",
        ) and by_id[111][3] and by_id[None][0] == "ISC"
    assert by_id[102][4:6] == ("GPL-3.0", "lib/sub") and by_id[3][4:6] == ("MIT", "lib") and by_id[109][4:6] == ("MIT", "third") and by_id[103][4:6] == (None,
        None) and by_id[107][0] is None
    assert licences.scan(docs.limit(0), "source").count() == 0


def test_whole_licence_texts_have_their_own_names(spark):
    """Texts as they lie in projects: with other line ends and breaks, a line of copyright, a word changed here and there."""
    from strata.llm import licence_texts as L

    r, rows = random.Random(1), [(i, f"some prose number {i} that is of no licence and for all", "en", "x", "", 0) for i in range(50)]
    for k, name in enumerate(L.FILED):
        words = L.whole_text(name).split()
        for at in r.sample(range(len(words)), 5):
            words[at] = "changed"
        text = "\r\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        rows.append((100 + k, f"Copyright 2024 Some One. All rights reserved.\n\n{text}", "doc", f"p{k}", "", 0))
    rows.append((200, "Terms of our own.\nAll rights reserved.\n" + "you may not do this with that " * 30, "terms", "own", "", 0))
    found = {x["doc_id"]: x for x in licences.scan(spark.createDataFrame(rows, SCHEMA), F.concat_ws("/", "source", "lang")).collect()}
    for k, name in enumerate(L.FILED):
        got = found[100 + k]
        assert (got["own_licence"], got["is_file"], got["line"]) == (name, True, -1) and got["lead"] > 0, (name, got)
    assert found[200]["own_licence"] in (None, "Proprietary") and not found[200]["is_file"]
    assert all(found[i]["own_licence"] is None for i in range(50))


def test_words_that_are_needed():
    """No vector without them reaches the threshold: the best that can do so is the template's own rest."""
    vectors = licences.Vectors(licences.TEMPLATES, defaultdict(lambda: 2.0, {"the": 0.1, "license": 0.9, "software": 0.5}))
    for least in (0.5, 0.6, 0.9):
        needed = vectors.needed(least)
        for own, size in vectors.weights:
            rest = math.sqrt(sum(v * v for w, v in own.items() if w not in needed))
            assert rest / size < least
    assert "the" not in vectors.needed(0.6)


def test_long_lines_count_from_two_sites(spark):
    passage, short = " ".join(f"word{k}" for k in range(60)), "a short line"
    rows = [(i, f"own {i}\n{passage}\n{short}", "en", f"site{i}", "", 0) for i in range(2)]
    rows += [(10 + i, f"{passage} of one site", "en", "site0", "", 0) for i in range(3)] + [(20, passage[:200], "en", "site5", "", 0)]
    rows += [(30 + i, passage.upper(), "en", f"site{i}", "", 0) for i in range(3)]  # copies of a whole text
    found = {r["doc_id"]: r["removed"] for r in line_dedup.marked_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {0: [1], 1: [1], 10: [], 11: [], 12: [], 20: [], 30: [], 31: [], 32: []}


def test_all_words_have_corpus_frequencies(spark):
    """Ordinary words of a header weigh little, and a verdict does not change when the corpus is repeated."""
    prose = "\n".join(["this project is for the file of you and see details in it"] * 40)
    said = "This project is released under the MIT License, see the file for details."
    rows = [(i, f"{prose}\nown{i}", "en", "a", "", 0) for i in range(20)] + [(100, said, "en", "b", "", 0),
        (101, "xylophone quartz released zebra under umbrella MIT violin", "en", "c", "", 0)]
    once = {r["doc_id"]: r["own_licence"] for r in licences.scan(spark.createDataFrame(rows, SCHEMA), "source").collect()}
    assert once[100] == "MIT" and once[101] is None and all(once[i] is None for i in range(20))
    more = [(i + 1000 * k, *rest) for k in range(10) for i, *rest in rows]
    again = {r["doc_id"]: r["own_licence"] for r in licences.scan(spark.createDataFrame(more, SCHEMA), "source").collect()}
    assert all(again[i + 1000 * k] == x for i, x in once.items() for k in range(10))


def test_units_unlike_any_licence_go_before_the_corpus_weights_come(spark, monkeypatch):
    """Words of many licences beside each other are likely at first, but their shares alone tell that no licence is near."""
    from strata.llm import licence_texts as L

    rows = [(i, f"noninfringement sublicense gnu mozilla perl creative x{i}", "en", "x", "", 0) for i in range(40)] + [(100, L.MIT, "en", "x", "", 0)]
    joined, join = [], licences.salted_join
    monkeypatch.setattr(licences, "salted_join", lambda big, small, keys, *rest: (keys == ["term"] and joined.extend(r["id"] for r in big.select("id").distinct().collect()),
        join(big, small, keys, *rest))[1])
    found = {r["doc_id"]: r["own_licence"] for r in licences.scan(spark.createDataFrame(rows, SCHEMA), "source").collect()}
    assert found == {i: None for i in range(40)} | {100: "MIT"} and set(joined) == {100}
