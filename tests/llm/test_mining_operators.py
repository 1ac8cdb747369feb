"""Collocations, personal data and whitening against plain versions, and on odd input."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import skip_chain, stripes
from tallyforge.llm.skip_chain import KINDS, LABELS, Field, Tokens, base_spans, personal_data
from tallyforge.llm.stripes import collocations
from tallyforge.llm.whitening import whitened


def plain_collocations(docs, least, percent, top):
    counts, sizes = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    found = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    rows = []
    for (lang, words), a in found.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * f >= percent * a and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), f in found.items()
        )
        if not inside:
            cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
            score, k = min((2_000_000 * a // (x + y), k) for k, (x, y) in enumerate(cuts))
            rows.append((lang, -score, -a, " ".join(words).encode(), *cuts[k]))
    made = []
    for lang in sizes:
        for rank, (_, score, a, phrase, x, y) in enumerate(sorted(r for r in rows if r[0] == lang)[:top], 1):
            made.append((lang, rank, phrase.decode(), -a, x, y, sizes[lang], -score))
    return sorted(made)


def _texts(seed, count):
    draw = random.Random(seed)
    words = ["The", "the", "of", "état", "x-1", "日本", "#", "a\x00b", "dog", "Ünder"]
    weights = [9, 9, 5, 2, 2, 1, 1, 1, 1, 1]
    for _ in range(count):
        yield "".join(w + draw.choice([" "] * 9 + ["  ", "\t", ". ", ",", "\n", "!?"]) for w in draw.choices(words, weights, k=draw.randint(0, 40)))


@pytest.mark.parametrize("size", [16, 200, stripes.CHUNK_BYTES])
def test_collocations(table, rows, size):
    docs = [(("en", "de", None)[k % 3], t) for k, t in enumerate(_texts(size, 150))]
    docs += [("en", None), ("fr", ""), ("en", "new york city " * 40), (None, "new york city " * 3)]
    df = table(docs, "lang string, text string").repartition(5)
    assert rows(collocations(df, least=5, top=40, chunk_bytes=size)) == plain_collocations(docs, 5, 80, 40)


def test_collocations_of_odd_tables(table, rows):
    df = table([("en", "a b. " * 40, 1)] * 3, "lang string, text string, doc_id long")
    clashing = df.withColumns({c: F.lit(1) for c in ("phrase", "prefix", "part", "f", "a", "l", "r", "k", "words", "total", "mark")})
    assert rows(collocations(clashing)) == [("en", 1, "a b", 120, 120, 120, 240, 1_000_000)]
    assert collocations(clashing.limit(0)).collect() == []
    assert collocations(table([("en", "a b c")], "lang string, text string")).collect() == []


def test_chunks_give_every_word_once_and_its_followers():
    data = b" ".join([b"w%d" % k + (b"\xff" if k % 37 == 36 else b"") for k in range(200)]) + b" " + b"y" * 500 + b" z"
    for size in (8, 40, 1 << 20):
        own = []
        for words, ahead in stripes.chunks(data, size):
            body = words[: len(words) - 1 - ahead]
            own += [w for w in body if w != b"\xff"]
            assert words[-1] == b"\xff" and ahead < stripes.LONGEST
        assert own == data.replace(b"\xff", b" ").split()


def test_large_counts_stay_exact(spark):
    a, side = (1 << 62) + 1, (1 << 62) + 3
    sql = f"cast((cast(2000000 as decimal(7,0)) * cast({a} as decimal(20,0))) div (cast({side} as decimal(20,0)) + cast({side} as decimal(20,0))) as long)"
    assert spark.sql(f"SELECT {sql}").first()[0] == 2_000_000 * a // (2 * side)


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        check = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and check % 10 == 0:
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return sorted(found)


def test_base_spans_against_the_patterns():
    draw = random.Random(4)
    bits = ["1", "255", "300", "00012", ".", ".", "-", " ", "@", "@", "a", "b.c", "é", "+", "+1", "(499)", "555-6503", "4539578763621486", "١", "\n", "mail.x.org"]
    for _ in range(4000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 14)))
        assert base_spans(text)[0] == plain_base(text), text
    long = "a" * 200_000 + "1" * 200_000 + "@" * 50_000 + "+1(((" * 50_000
    assert base_spans(long)[0] == []


def test_messages_are_exact_on_a_forest():
    draw = np.random.default_rng(5)
    field = Field(np.zeros((1, LABELS)), draw.normal(size=(LABELS, LABELS)), (lambda s: s + s.T)(draw.normal(size=(LABELS, LABELS))))
    chain, skip, n = np.array([[0, 1], [1, 2]]), np.array([[1, 3], [3, 4]]), 6
    scores = draw.normal(size=(n, LABELS))
    scores[4, :2] = -np.inf
    chances = np.zeros((n, LABELS))
    for labels in itertools.product(range(LABELS), repeat=n):
        total = sum(scores[k, y] for k, y in enumerate(labels))
        total += sum(field.chain[labels[a], labels[b]] for a, b in chain) + sum(field.skip[labels[a], labels[b]] for a, b in skip)
        chances[np.arange(n), labels] += np.exp(total)
    expected = chances / chances.sum(axis=1, keepdims=True)
    assert np.allclose(field.marginals(scores, chain, skip, rounds=200, tolerance=1e-12), expected, atol=1e-8)
    none = np.zeros((0, 2), int)
    alone = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert np.allclose(field.marginals(scores, none, none), alone)


def test_similar_tokens_are_tied_in_a_chain():
    text = "call 5556503 or (499) 555-6503 then 499-555-6503 and bob@mail or Bob@x.org 5556503"
    tokens = Tokens(text, *base_spans(text))
    shown = [text[a:b] for a, b in zip(tokens.starts, tokens.stops)]
    assert shown == ["5556503", "(499)", "555-6503", "499-555-6503", "bob@mail", "Bob@x.org", "5556503"]
    assert tokens.chain == [(1, 2), (5, 6)] and {(0, 2), (2, 3), (4, 5), (2, 6)} <= set(tokens.skip)
    many = Tokens("77777 x " * 1000, [], [])
    assert len(many.skip) == 999


def _people(count):
    draw = random.Random(6)
    for k in range(count):
        phone = f"+{draw.randint(1, 9)} ({draw.randint(200, 999)}) {draw.randint(200, 999)}-{draw.randint(1000, 9999)}"
        yield f"reach {phone} or mail p{k}@host{k % 7}.example.com from {draw.randint(1, 255)}.{draw.randint(0, 255)}.3.9 in {(year := draw.randint(1900, 2030))} room {draw.randint(1, 99)}. since {year} again {phone}"


def test_repeated_numbers_get_the_label_of_their_other_mention(table):
    hidden = "write to ann at +1 (499) 555-6503 soon. later the office heard 499-555-6503 once more in 1987"
    docs = dict(enumerate([*_people(300), hidden, "only 1987 and 2024 here", "call +1 (269) 555-3296 4539578763621486 now"]))
    found = {r["doc_id"]: r for r in personal_data(table(list(docs.items()), "doc_id long, text string").repartition(3)).collect()}
    for k, text in docs.items():
        expected = plain_base(text)
        assert found[k]["base"] == ",".join(f"{KINDS[c]}:{a}:{b}" for a, c, b in expected)
        assert tuple(found[k][f"n_{name}"] for name in KINDS) == tuple(sum(c == i for _, c, _ in expected) for i in range(4))
        assert not expected or set(found[k]["base"].split(",")) <= set(found[k]["spans"].split(","))
    texts = lambda k: [docs[k][int(a) : int(b)] for _, a, b in (s.split(":") for s in found[k]["spans"].split(",") if s)]
    assert texts(300) == ["+1 (499) 555-6503", "499-555-6503"]
    assert texts(301) == []
    assert found[302]["base"] == "" and texts(302)[0].startswith("+1 (269) 555-3296")
    added = sum(found[k]["spans"] != found[k]["base"] for k in range(300))
    assert added <= 3  # years and rooms stay


def test_personal_data_of_odd_tables(table):
    texts = [None, "", " \n", "x", "é 1.2.3.4 日本 a@b.co", "9" * 30_000, "@" * 500, "1 " * 5000]
    df = table([(None if k == 4 else k % 3, t) for k, t in enumerate(texts)], "doc_id int, text string")
    df = df.withColumns({c: F.lit(1) for c in ("key", "base", "spans", "n_ip", "label", "draw")})
    made = personal_data(df)
    assert made.schema["doc_id"].dataType.simpleString() == "int" and made.count() == len(texts)
    assert made.filter("doc_id IS NULL").first()["spans"] == "ip:2:9,email:13:19"
    assert personal_data(df.limit(0)).collect() == []
    # Nothing to learn from: the patterns alone.
    assert [r["spans"] for r in personal_data(table([(1, "in 1987")], "doc_id long, text string")).collect()] == [""]


def test_the_fit_is_a_bounded_sample(table):
    df = table(list(enumerate(_people(400))), "doc_id long, text string")
    model = skip_chain.fit(df, fit_sites=100)
    assert model is not None and np.allclose(model.skip, model.skip.T)


def plain_whitening(vectors, by_count):
    x = np.floor(256 * np.array([v for v in vectors.values()], float)).astype(np.int64)
    fit, counts = np.unique(x, axis=0, return_counts=True)
    counts = counts if by_count else np.ones(len(fit), int)
    n, sums = int(counts.sum()), (fit * counts[:, None]).sum(axis=0)
    centred = fit - sums / n
    cov = (centred * counts[:, None]).T @ centred / n
    values, axes = np.linalg.eigh(cov)
    return x, n, sums, values[::-1], axes[:, ::-1], np.trace(cov)


@pytest.mark.parametrize("by_count", [False, True])
def test_whitening(table, by_count):
    draw = np.random.default_rng(2)
    base = (draw.normal(size=(60, 6)) * [3, 2, 1.5, 1, 0.5, 0.2]).astype("float32")
    vectors = {k: base[min(k, 59)].tolist() for k in range(200)}  # one vector is most rows
    found = whitened(table(list(vectors.items()), "vec_id long, embedding array<float>").repartition(4), by_count=by_count).collect()
    x, n, sums, values, axes, trace = plain_whitening(vectors, by_count)
    assert len(found) == 4 * len(vectors)
    signs = {}
    for r in found:
        c = r["component"] - 1
        expected = float((x[r["vec_id"]] - sums / n) @ axes[:, c] / np.sqrt(values[c]))
        signs.setdefault(c, np.sign(expected) * np.sign(r["whitened"]))
        assert r["whitened"] * signs[c] == pytest.approx(expected, abs=1e-9)
        assert r["deviation"] == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[r["vec_id"]], sums))
        assert r["n"] == n and r["explained"] == pytest.approx(values[c] / trace, rel=1e-9) and r["identity_error"] < 1e-9


def test_whitening_of_odd_rows(table, rows):
    nan, far = float("nan"), 1e300
    vectors = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [-0.0, 3.0]), (2, [1.5, -2.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [far, 1.0]), (7, []), (8, [1.0]), (9, [float("-inf"), 0.0])]
    df = table(vectors, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("key", "x", "c", "copies", "n", "whitened", "place")})
    found = rows(whitened(df).select("vec_id", "component", "n"))
    assert found == [(None, 1, 3), (None, 2, 3), *[(1, 1, 3)] * 2, *[(1, 2, 3)] * 2, (2, 1, 3), (2, 2, 3)]
    assert whitened(df.limit(0)).collect() == [] and whitened(df.filter("vec_id = 1")).collect() == []
    flat = whitened(table([(k, [float(k), 1.0]) for k in range(5)], "vec_id long, embedding array<float>"))
    assert {r["component"] for r in flat.collect()} == {1}


def test_deviation_beyond_machine_integers(table):
    big = 2.0**30
    found = whitened(table([(0, [0.0, 0.0]), (1, [big, 1.0]), (2, [2.0, big * 64])], "vec_id long, embedding array<double>")).collect()
    x = [[0, 0], [int(256 * big), 256], [512, int(256 * big * 64)]]
    sums = [sum(c) for c in zip(*x)]
    exact = {k: sum((3 * v - s) ** 2 for v, s in zip(row, sums)) for k, row in enumerate(x)}
    assert all(r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None) for r in found)
    small = whitened(table([(0, [0.0, 0.0]), (1, [2.0**21, 1.0]), (2, [2.0, 5.0])], "vec_id long, embedding array<double>")).collect()
    assert all(r["deviation"] is not None and r["deviation"] > 1 << 57 for r in small if r["vec_id"] == 1)
