"""Operators against plain versions, and on nulls, empty and long texts, repeated rows, odd names and empty tables."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import public_tokenizers
from tallyforge.llm import bin_packing, chaining, edit_join, embedding_lsh, importance
from tallyforge.llm.batches import mapped
from tallyforge.llm.difference_cover import without_earlier_strings
from tallyforge.llm.graph import components
from tallyforge.llm.hyper_minhash import near_duplicates
from tallyforge.llm.line_frequency import judged, repeated_words
from tallyforge.llm.overlap_counts import count_tokens, runs
from tallyforge.llm.trie_bpe import decode, encode_and_decode

PATH = public_tokenizers.path("word_bpe_49k.json")
BASE = brute.prose(1, 120)
#: Null and repeated keys, null, empty, blank, short, long and repeated texts, a text without any space.
MESSY = [
    (1, BASE),
    (1, BASE),
    (2, None),
    (3, ""),
    (4, " \n\t \n"),
    (5, "one"),
    (6, "x" * 3000 + "<|endoftext|>" + "y" * 50),
    (7, brute.edited(BASE, 1, 1)),
    (8, BASE),
    (9, "Ünïcödé ẞ İ ’quotes’ 日本語 😀 é  wide\n" * 4),
    (10, brute.prose(2, 3000)),
    (None, BASE),
    (None, None),
]
#: Names that the operators use inside.
ODD = ["key", "row", "print", "host", "class", "shard", "rep", "kind", "chunk", "_row", "_doc", "component", "lines"]


@pytest.fixture
def messy(table):
    df = table([(k, t, "en", "src", 0) for k, t in MESSY], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({name: F.lit(1) for name in ODD})


@pytest.fixture
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 8), (512, 16), (32_768, 256)])
def test_token_counts(messy, empty, library, chunk, overlap):
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in count_tokens(messy, PATH, chunk_chars=chunk, overlap_chars=overlap).collect())
    expected = [(k, t or "", len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in MESSY]
    assert found == sorted((k is None, k or 0, len(t.encode()), n) for k, t, n in expected)
    assert count_tokens(empty, PATH).collect() == []


def test_runs():
    assert runs([1, 2, 2, 5, 6, 9]) == [(1, 2), (5, 6), (9, 9)] and runs([]) == []


def test_encoding_and_decoding(spark, messy, empty, library, table):
    draw = random.Random(3)
    letters = list("abcTHE the aaa'sré!!.,  \n\té한日😀½٣\x1c\x85́#%") + ["<|endoftext|>", "<|startoftext|>", "'re", "hello", "haha" * 5]
    texts = [t for _, t in MESSY] + ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(500)]
    df = table(list(enumerate(texts)), "doc_id long, text string")
    coded = encode_and_decode(df, PATH)
    again = {r["doc_id"]: r["decoded"] for r in decode(coded.drop("decoded"), PATH).collect()}
    for r in coded.collect():
        expected = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == expected
        assert r["decoded"] == again[r["doc_id"]] == library.decode(expected, skip_special_tokens=False)
    assert encode_and_decode(messy, PATH).count() == len(MESSY) and encode_and_decode(empty, PATH).collect() == []


def test_other_tokenizer_files_are_refused():
    from tallyforge.llm.tokenizer import WordTokenizer

    with pytest.raises(ValueError, match="white space"):
        WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_components(table, rows):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + draw.randrange(60), 100 + draw.randrange(60)) for _ in range(30)] + [(200, k) for k in range(201, 260)]
    found = dict(rows(components(table([*edges, (5, 5), (None, 1)], "a long, b long"))))
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    assert found == {n: c for n, c in brute.components(nodes, edges).items() if n in nodes}
    assert rows(components(table([], "a long, b long"))) == []


def test_near_duplicates(table):
    docs = {0: "", 1: None, 2: "a b c", 3: "A b\tC", 4: "a b c d"}
    for family in range(6):
        base = brute.prose(family + 10, 90)
        for k in range(14):
            docs[100 * family + 10 + 7 * k] = brute.edited(base, family * 100 + k, k % 6)
    for n in (4, 5):
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(table(list(docs.items()), "doc_id long, text string"), words=n).collect()}
        assert found == brute.near_duplicates(docs, n)
    assert len({c for _, c in found.values()}) < len(docs) - 10


def test_near_duplicates_of_messy_rows(messy, empty):
    found = sorted((r["doc_id"] or -1, r["component_id"] if r["component_id"] is not None else -1) for r in near_duplicates(messy).collect())
    assert found == [(-1, -1), (-1, -1), (1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 1), (8, 1), (9, 9), (10, 10)]
    assert near_duplicates(empty).collect() == []


def test_quality_rules(messy, empty, table):
    for r, (k, t) in zip(judged(messy.coalesce(1), carry=["lang", "key"]).collect(), MESSY):
        expected = brute.measures(t)
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert (r["doc_id"], tuple(r)[1:6], r["base_failed"], r["kept"], r["cleaned"]) == (k, expected, failed, not failed, t)
        assert r["carried"]["lang"] == "en"
    assert judged(empty).collect() == []
    assert repeated_words(b"a b c a b c d".split()) == 6


def test_frequent_lines_reject_depleted_documents_but_not_copies(table):
    common = brute.prose(5, 40).replace("\n", "")
    rows = [(k, f"{brute.prose(100 + k, 70)}\n{common}\n{brute.prose(200 + k, 20)}", "a") for k in range(40)]
    rows += [(100 + k, f"{brute.prose(300 + k, 12)}\n{common}\n{brute.prose(400 + k, 8)}", "a") for k in range(3)]
    rows += [(200 + k, brute.prose(7, 90), "a") for k in range(60)] + [(300 + k, f"{common}\n{brute.prose(9 + k, 90)}", None) for k in range(5)]
    found = {r["doc_id"]: r for r in judged(table(rows, "doc_id long, text string, source string"), share=0.1).collect()}
    assert {k for k, r in found.items() if not r["kept"]} == {100, 101, 102}
    assert found[0]["n_removed_words"] == 40 and common not in found[0]["cleaned"]
    assert found[200]["n_removed_words"] == found[300]["n_removed_words"] == 0


def test_a_block_of_frequent_lines_goes_whole_but_copies_stay(table):
    block = [brute.prose(8000 + k, 8).replace("\n", "") for k in range(5)]
    rows = [(k, "\n".join([brute.prose(8100 + k, 70), *block, brute.prose(8200 + k, 20)]), "a") for k in range(40)]
    rows += [(100 + k, "\n".join([brute.prose(8300 + k, 12), *block, brute.prose(8400 + k, 8)]), "a") for k in range(3)]
    rows += [(300 + k, brute.prose(9, 90), "a") for k in range(60)]
    found = {r["doc_id"]: r for r in judged(table(rows, "doc_id long, text string, source string"), share=0.1).collect()}
    assert all(found[k]["n_removed_words"] == 40 for k in (*range(40), 100, 101, 102))
    assert {k for k, r in found.items() if not r["kept"]} == {100, 101, 102}
    assert found[300]["n_removed_words"] == 0


def _through_sql(rows):
    """The rows of the query's SQL for documents ``doc_id, text, source``."""
    import duckdb

    from tallyforge.llm.queries import entries

    connection = duckdb.connect()
    connection.register("documents", pa.table(dict(zip(("doc_id", "text", "source"), map(list, zip(*rows))))))
    cursor = connection.execute(entries()["op3_quality_rules"].sql)
    names = [d[0] for d in cursor.description]
    return sorted((dict(zip(names, r)) for r in cursor.fetchall()), key=lambda r: r["doc_id"])


def test_the_rule_on_frequent_lines_is_that_of_the_sql(table):
    pool = [brute.prose(8500 + k, 8).replace("\n", "") for k in range(60)]
    # Documents of frequent lines only, in every order.
    boiler = [(k, "\n".join(random.Random(k).sample(pool, 30)), "a") for k in range(300)]
    block = [brute.prose(8600 + k, 8).replace("\n", "") for k in range(5)]
    blocks = [(1000 + k, "\n".join([brute.prose(8700 + k, 70), *block, brute.prose(8800 + k, 20)]), "b") for k in range(40)]
    copies = [(2000 + k, brute.prose(11, 90).replace(" ", "  " if k % 2 else " "), "c") for k in range(60)]
    other = [(3000 + k, brute.prose(9000 + k, 90), ("c", None)[k % 2]) for k in range(30)] + [(4000, None, "c"), (4001, "", None)]
    rows = boiler + blocks + copies + other
    expected = _through_sql(rows)
    found = sorted((r.asDict() for r in judged(table(rows, "doc_id long, text string, source string")).drop("cleaned").collect()), key=lambda r: r["doc_id"])
    assert found == expected
    kept = {r["doc_id"]: r["kept"] for r in found}
    removed = {r["doc_id"]: r["n_removed_words"] for r in found}
    assert not any(kept[k] for k in range(300)) and all(removed[1000 + k] == 40 for k in range(40))
    assert all(kept[2000 + k] and not removed[2000 + k] for k in range(60))


def test_a_large_family_of_lines_leaves_counts_and_not_pairs(table, monkeypatch):
    monkeypatch.setattr(edit_join, "BLOCK", 16)
    base = brute.prose(60, 20).replace("\n", "")
    letters = "".join(chr(0x4E00 + k) for k in range(400))
    docs = [(k, base[:30] + letters[k] + base[31:]) for k in range(200)] + [(500, base), (501, brute.prose(61, 20).replace("\n", ""))]
    df = table(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["line_no"]): (r["n_links"], r["class_key"], r["class_line_no"], r["kept"]) for r in edit_join.near_lines(df).collect()}
    assert found == brute.near_lines(docs) and found[500, 0][0] == 200
    assert edit_join.links(df, 2, 20).count() < 201 * 16


def test_near_lines(table):
    draw, docs = random.Random(4), []
    lines = [brute.prose(50 + k, 8).replace("\n", "") for k in range(12)] + ["short", "shorT", "", "  "]
    for k in range(40):
        own = []
        for line in draw.choices(lines, k=4):
            at = draw.randrange(len(line) + 1)
            own.append(draw.choice([line, line, line[:at] + "z" + line[at:], line[:at] + line[at + 1 :], line[:at] + "qr" + line[at + 2 :], f" {line} "]))
        docs.append((k, "\n".join(own)))
    found = {
        (r["doc_id"], r["line_no"]): (r["n_links"], r["class_key"], r["class_line_no"], r["kept"])
        for r in edit_join.near_lines(table(docs, "doc_id long, text string")).collect()
    }
    assert found == brute.near_lines(docs)


def test_near_lines_of_messy_rows(messy, empty):
    found = edit_join.near_lines(messy)
    assert found.filter("doc_id = 1").count() == 2 * found.filter("doc_id = 8").count()
    assert found.filter("doc_id = 1 AND NOT kept").count() == 0 and found.filter("(doc_id = 8 OR doc_id IS NULL) AND kept").count() == 0
    assert edit_join.near_lines(empty).collect() == []
    left = edit_join.without_later_copies(messy)
    assert left.columns == messy.columns
    kept = sorted((r["doc_id"] or -1, r["text"] or "") for r in left.collect())
    assert [k for k, _ in kept] == [-1, 1, 1, 2, 3, 4, 5, 6, 7, 9, 10] and dict(kept)[1] == BASE
    assert edit_join.without_later_copies(empty).collect() == []


@pytest.mark.parametrize("index", [True, False])
def test_keys_of_a_slice_of_lines_take_little_memory(index):
    lines = [f"{k} {brute.prose(k, 9)}" for k in range(30_000)]
    batch = pa.RecordBatch.from_pydict({"text": ["\n".join(lines[k : k + 20]) for k in range(0, len(lines), 20)]})
    assert batch.column("text").nbytes > 1 << 20
    work = mapped(lambda piece: edit_join._keys(edit_join._distinct_lines(piece), 2, 20, index), "text", edit_join._KEYS, edit_join._SLICE)
    tracemalloc.start()
    try:
        made = sum(keys.num_rows for keys in work([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made > 2 * len(lines)
    assert peak < 25_000_000


def test_banded_distance():
    draw = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(draw.choices("ab", k=draw.randint(0, 9))) for _ in range(2))
        for limit in range(4):
            assert edit_join.banded_distance(a, b, limit) == min(brute.edit_distance(a, b), limit + 1)


def test_chains_have_the_best_score():
    draw = random.Random(6)
    for _ in range(60):
        points = sorted({(draw.randrange(60), draw.randrange(60)) for _ in range(25)})
        score: list[float] = []
        for i, (x, y) in enumerate(points):
            before = [score[j] - chaining.GAP * (x - u + y - v) for j, (u, v) in enumerate(points[:i]) if u < x and v < y]
            score.append(chaining.SEED + max([0.0, *before]))
        found = chaining.chains([x for x, _ in points], [y for _, y in points], 0)
        first = found[0]
        own = chaining.SEED * len(first) - chaining.GAP * (points[first[-1]][0] - points[first[0]][0] + points[first[-1]][1] - points[first[0]][1])
        assert own == pytest.approx(max(score))
        assert all(points[a][0] < points[b][0] and points[a][1] < points[b][1] for c in found for a, b in zip(c, c[1:]))
        used = [i for c in found for i in c]
        assert len(used) == len(set(used))


def test_shared_passages(table, messy, empty):
    passage = brute.prose(60, 80)
    docs = [(k, f"{brute.prose(500 + k, 100)} {brute.edited(passage, k, k % 5)} {brute.prose(600 + k, 60)}") for k in range(12)]
    docs += [(50 + k, brute.prose(700 + k, 200)) for k in range(10)]
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 12)) and all(r["other_doc_id"] < r["doc_id"] for r in found)
    assert all(90 <= r["start_word"] <= 130 and 50 <= r["n_words"] <= 90 for r in found)
    by = sorted((r["doc_id"], r["other_doc_id"], r["n_words"]) for r in chaining.shared_passages(messy).collect())
    assert by == [(7, 1, 120), (8, 1, 120)]
    assert chaining.shared_passages(empty).collect() == []


@pytest.mark.parametrize("between", [0, 30, 80, 150, 400])
def test_two_passages_far_apart_in_one_pair_are_both_found(table, between):
    head, foot = (brute.prose(k, 60) for k in (61, 62))
    docs = [(k, f"{brute.prose(800 + k, 40)} {head} {brute.prose(820 + k, between)} {foot} {brute.prose(840 + k, 40)}") for k in (1, 2)]
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    words = {i for r in found for i in range(r["start_word"], r["start_word"] + r["n_words"])}
    assert words >= {*range(40, 100), *range(100 + between, 160 + between)}
    assert all(100 * r["same_words"] >= 80 * max(r["n_words"], r["other_words"]) and r["n_words"] >= 50 for r in found)


@pytest.mark.parametrize(("words", "edits", "least"), [(60, 2, 1.0), (60, 4, 1.0), (60, 6, 0.98), (60, 8, 0.95), (60, 11, 0.85), (100, 10, 1.0)])
def test_edited_passages_are_found(table, words, edits, least):
    docs, truth, draw = [], set(), random.Random(words + edits)
    for k in range(60):
        passage = brute.prose(5000 + k, words).replace("\n", "").split(" ")
        other = list(passage)
        for at in draw.sample(range(words), edits):
            other[at] = f"w{draw.randrange(10**6)}"
        for key, text in ((k, passage), (100 + k, other)):
            docs.append((key, f"{brute.prose(6000 + key, 40)} {' '.join(text)} {brute.prose(6500 + key, 40)}"))
        # What is equal from the first to the last equal word; the words around are other ones.
        same = [i for i in range(words) if passage[i] == other[i]]
        if same[-1] - same[0] + 1 >= 50 and 100 * len(same) >= 80 * (same[-1] - same[0] + 1):
            truth.add(100 + k)
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    got = {r["doc_id"] for r in found if r["doc_id"] == r["other_doc_id"] + 100}
    assert len(truth) >= 40 and len(got & truth) >= least * len(truth)


def test_a_passage_whose_parts_are_elsewhere_first_is_found(table):
    # Both parts and the joint between them are in earlier documents that do not have the passage.
    parts = [brute.prose(7000 + k, 45).replace("\n", "") for k in range(2)]
    joint = " ".join(parts[0].split()[-8:] + parts[1].split()[:8])
    texts = {1: parts[0], 2: parts[1], 3: joint, 5: " ".join(parts), 9: " ".join(parts)}
    docs = [(k, f"{brute.prose(7100 + k, 90)} {t} {brute.prose(7200 + k, 90)}") for k, t in texts.items()]
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    assert [r["n_words"] >= 90 for r in found if (r["doc_id"], r["other_doc_id"]) == (9, 5)] == [True]


def test_a_passage_with_every_fifth_word_changed_is_found(table):
    docs = []
    for k in range(20):
        passage = brute.prose(7300 + k, 99).replace("\n", "").split()[:99]
        other = [f"x{k}y{i}" if i % 5 == 4 else w for i, w in enumerate(passage)]
        for key, words in ((k, passage), (100 + k, other)):
            docs.append((key, f"{brute.prose(7400 + key, 40)} {' '.join(words)} {brute.prose(7600 + key, 40)}"))
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_doc_id"]) for r in found} >= {(100 + k, k) for k in range(20)}


def test_a_passage_whose_every_stretch_is_in_forty_earlier_documents_is_found(table):
    words = [f"p{k}" for k in range(60)]
    docs = []
    for k in range(40):
        stretches = [words[at : at + 14 + k % 3] for at in range(0, 60, 7)]
        docs.append((k, " ".join(f"{' '.join(s)} {brute.prose(7800 + 50 * k + i, 12)}" for i, s in enumerate(stretches))))
    docs += [(key, f"{brute.prose(key, 50)} {' '.join(words)} {brute.prose(key + 10, 50)}") for key in (5000, 5001)]
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    assert any((r["doc_id"], r["other_doc_id"]) == (5001, 5000) and r["n_words"] >= 60 for r in found)


@pytest.mark.parametrize(("holders", "own"), [(3, 0), (20, 12)])
def test_an_edited_passage_whose_stretches_are_in_documents_before_and_between_is_found(table, holders, own):
    """Neither the first holders nor the ones before the copy have it; with 20 holders on both sides only its last words are in few."""
    words = [f"p{k}" for k in range(60)]
    edited = [f"e{k}" if k in (9, 28, 40) else w for k, w in enumerate(words)]

    def stretch(k: int) -> str:
        parts = (words[at : at + 11] for at in range(0, 60 - own, 7))
        return " ".join(f"{' '.join(w for w in part if int(w[1:]) < 60 - own)} {brute.prose(12_000 + 50 * k + i, 12)}" for i, part in enumerate(parts))

    docs = [(k, stretch(k)) for k in (*range(holders), *range(200, 200 + holders))]
    docs += [(key, f"{brute.prose(20_000 + key, 50)} {' '.join(w)} {brute.prose(20_100 + key, 50)}") for key, w in ((100, words), (300, edited))]
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    assert any((r["doc_id"], r["other_doc_id"]) == (300, 100) and r["n_words"] >= 59 for r in found)


@pytest.mark.parametrize("kinds", ["d", "i", "sdi"])
def test_passages_with_words_put_in_and_left_out_are_found(table, kinds):
    docs = []
    for k in range(40):
        passage = brute.prose(9000 + k, 70).replace("\n", "")
        for key, t in ((k, passage), (100 + k, brute.moved(passage, k, 8, kinds))):
            docs.append((key, f"{brute.prose(9100 + key, 40)} {t} {brute.prose(9300 + key, 40)}"))
    found = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    assert len({(r["doc_id"], r["other_doc_id"]) for r in found} & {(100 + k, k) for k in range(40)}) >= 36


def test_equal_runs_of_an_earlier_document_are_all_told(table):
    """Against every run of so many words that stands in a document with a smaller key; copies, heavy seeds and keys that repeat."""
    draw, pieces = random.Random(3), [[f"s{p}w{i}" for i in range(40)] for p in range(6)]
    docs = []
    for k in range(50):
        words = [f"d{k}w{i}" for i in range(30)]
        for _ in range(draw.randint(1, 5)):
            words += draw.choice(pieces)[draw.randint(0, 5) :] + [f"d{k}x{draw.randrange(9)}"] * draw.randint(0, 1)
        docs.append((k, " ".join(words)))
    docs += [(60 + k, docs[k][1].upper()) for k in range(5)] + [(70, docs[0][1]), (70, "z z"), (None, docs[1][1])]
    by_key = {k: t for k, t in docs if k is not None and t != "z z"}
    found = chaining.shared_passages(table([d for d in docs if d != (70, "z z")], "doc_id long, text string")).collect()
    told = {k: set() for k in by_key}
    for r in found:
        told[r["doc_id"]] |= set(range(r["start_word"], r["start_word"] + r["n_words"]))
        mine, other = (by_key[r[c]].lower().split()[r[a] : r[a] + r[n]] for c, a, n in (("doc_id", "start_word", "n_words"), ("other_doc_id", "other_start", "other_words")))
        assert chaining.common_words(np.array(mine), np.array(other)) >= r["same_words"] >= 0.8 * max(len(mine), len(other))
    before: set[tuple] = set()
    for k in sorted(by_key):
        words = by_key[k].lower().split()
        runs = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        due = {i + j for i, run in enumerate(runs) if run in before for j in range(50)}
        assert due <= told[k]
        before |= set(runs)
    again = chaining.shared_passages(table(docs, "doc_id long, text string")).collect()
    assert all(r["n_words"] <= len(by_key[r["doc_id"]].split()) for r in again)


def test_text_that_repeats_itself_has_as_many_rows_as_cover_it(table):
    """Runs of one word and of two, longer than those of the earlier document, and a passage that it has in three places."""
    once, twice = ["aa"] * 120, ["bb", "cc"] * 90
    docs = {1: [*once, *brute.prose(1, 30).split(), *twice], 2: [*brute.prose(2, 30).split(), *once * 2, *brute.prose(3, 30).split(), *twice * 2]}
    words = [f"v{k}" for k in range(100)]
    docs[3] = [*words[:60], *brute.prose(4, 300).split(), *words[11:80], *brute.prose(5, 300).split(), *words[31:]]
    docs[4] = [*brute.prose(6, 30).split(), *words]
    found = chaining.shared_passages(table([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")).collect()
    told = {k: {i for r in found if r["doc_id"] == k for i in range(r["start_word"], r["start_word"] + r["n_words"])} for k in docs}
    start = len(docs[2]) - len(twice) * 2
    assert told[2] >= {i for i, w in enumerate(docs[2]) if w in ("aa", "bb", "cc")} and start in told[2]
    assert told[4] >= set(range(len(docs[4]) - 100, len(docs[4])))
    assert sum(r["doc_id"] == 2 for r in found) <= 20


def test_fewest_runs_cover_what_all_cover():
    draw = random.Random(4)
    for _ in range(300):
        runs = sorted({(draw.randrange(200), draw.randrange(40), 50 + draw.randrange(4)) for _ in range(draw.randrange(1, 40))})
        kept = chaining._fewest(runs)
        covered = [{i for x, _, n in some for i in range(x, x + n)} for some in (runs, kept)]
        assert covered[0] == covered[1] and set(kept) <= set(runs) and len(kept) <= 12
    assert chaining._fewest(apart := [(0, 100, 60), (11, 500, 69), (31, 900, 69)]) == apart


def _short_chains(seed: int) -> list[tuple]:
    """Words of both sides around a chain of one run or two, from unlike texts to nearly equal ones, and its places."""
    rng, made = random.Random(seed), []
    for _ in range(300):
        before, after = rng.randint(0, 64), rng.randint(0, 64)
        share, words = rng.random(), rng.choice([30, 500, 100_000])
        run = [rng.randrange(words) for _ in range(4)]
        one = [rng.randrange(words) for _ in range(before)] + run + [rng.randrange(words) for _ in range(after)]
        two = [w if rng.random() < share else rng.randrange(words) for w in one[:before]] + run
        two += [w if rng.random() < share else rng.randrange(words) for w in one[before + 4 :]]
        one, two = ((np.array(t, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for t in (one, two))
        ends = [(before, before, 1)]
        if rng.random() < 0.4 and after > 9 and (one[before + 6 : before + 10] == two[before + 6 : before + 10]).all():
            ends.append((before + 6, before + 6, 1))
        made.append((one, two, *map(list, zip(*ends))))
    return made


def test_chains_without_enough_common_words_are_not_fetched():
    made = _short_chains(3)
    marks = [[(side >> np.uint64(56)).astype(np.uint8).tobytes() for side in sides] for sides in zip(*(m[:2] for m in made))]
    first, size = np.array([m[2][0] for m in made]), np.array([m[2][-1] + 4 - m[2][0] for m in made])
    solo = np.array([len(m[2]) == 1 for m in made])
    kept = chaining._may_pass(*marks, first, first, size, size, solo, 80 * 50)
    passing = np.array([len(chaining.alignment(*m)[0]) >= 40 for m in made])
    assert not (passing & ~kept).any()
    assert passing.sum() > 50 and (~kept).sum() > 50 and (kept & ~passing).sum() < 0.2 * len(made)
    assert len(chaining._may_pass([], [], *np.zeros((4, 0), np.int64), np.zeros(0, bool), 4000)) == 0


def test_words_are_fetched_for_likely_chains_only(table):
    shared, docs = brute.prose(1, 60), []
    for k in range(40):
        # Every text has four words of the next one; the last two share a passage.
        docs.append((k, " ".join([brute.prose(100 + k, 60), f"p{k} q{k} r{k} s{k}", brute.prose(200 + k, 60), f"p{k + 1} q{k + 1} r{k + 1} s{k + 1}", brute.prose(300 + k, 60)])))
    docs += [(50, "a " + shared), (51, "b " + shared)]
    rows = table(docs, "key long, text string")
    seeds = [(k + 1, 60, 64, k, 124, 128, np.array([60, 124, 1], "<i4").tobytes(), k) for k in range(39)]
    seeds.append((51, 1, 5, 50, 1, 5, np.array([1, 1, 1], "<i4").tobytes(), 99))
    known = table(seeds, chaining._CHAIN_DDL + ", chain long")
    found = [r["chain"] for r in chaining._likely(rows, known, 50, 80).collect()]
    assert 99 in found and len(found) < 8


def test_a_pair_with_one_seed_is_a_chain_if_frequent_ones_are_near():
    columns = zip((5, 2, 3, 9, 5), (5, 3, 4, 9, 6), (6, 1, 7, 8, 7), (7, 1, 7, 8, 5), (7, 2, 7, 8, 6), (8, 1, -4, -6, 0))
    arrays = [pa.array(c, f.type) for c, f in zip(columns, chaining._MET)]
    batch = pa.RecordBatch.from_arrays(arrays, schema=chaining._MET)
    for cut in range(batch.num_rows + 1):
        made = [r for b in chaining._chained(4.0, 7, 47)([batch[:cut], batch[cut:]]) for r in b.to_pylist()]
        seeds = lambda *z: np.array(z, "<i4").tobytes()
        expected = [(5, 3, 4, 8, 9, 13, seeds(4, 9, 1)), (6, 1, 7, 11, 8, 12, seeds(7, 8, 1)), (7, 2, 7, 11, 8, 12, seeds(7, 8, 1)), (8, 1, 3, 53, 5, 55, seeds(3, 5, 47))]
        names = ("key", "other", "start", "stop", "other_start", "other_stop", "seeds")
        assert sorted(tuple(r[c] for c in names) for r in made) == expected


def test_light_seeds_in_a_row_are_told_by_their_ends():
    """Documents 1 and 2 share a run of ten seeds, 1 and 3 its middle, 2 and 3 that and one seed more by itself."""
    held = {1: {k: 100 + k for k in range(10)}, 2: {5 + k: 100 + k for k in range(10)} | {40: 900}, 3: {70 + k: 103 + k for k in range(4)} | {30: 900}}
    made = []
    for key, seeds in held.items():
        for place, seed in seeds.items():
            made.append((seed, key, place, 6, seeds.get(place - 1, 0), seeds.get(place + 1, 0)))
    made.sort()
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), chaining._SEEDED)], schema=chaining._SEEDED)
    none = SimpleNamespace(value=[np.zeros(0, np.int64)] * 3)
    for cut in range(batch.num_rows + 1):
        met = pa.Table.from_batches(chaining._holders(none)([batch[:cut], batch[cut:]]), chaining._MET)
        assert met.num_rows == 7
        met = met.sort_by([("key", "ascending"), ("other", "ascending")]).combine_chunks().to_batches()
        found = [r for b in chaining._chained(4.0, 7, 47)(met) for r in b.to_pylist()]
        told = sorted((r["key"], r["other"], *np.frombuffer(r["seeds"], "<i4").tolist()) for r in found)
        assert told == [(2, 1, 5, 0, 10), (3, 1, 70, 3, 4), (3, 2, 30, 40, 1), (3, 2, 70, 8, 4)]


def test_ends_of_many_chains_are_aligned_as_one_by_one():
    made = [m for m in _short_chains(5) if len(m[2]) == 1]
    sides = [[(side >> np.uint64(32)).astype("<u4") for side in sides] for sides in zip(*(m[:2] for m in made))]
    here, there = (np.array([m[k][0] for m in made]) for k in (2, 3))
    ends = chaining._ends_alone(*([w.tobytes() for w in words] for words in sides), here, there, np.full(len(made), chaining.SEED))
    for one, two, x, y, own in zip(*sides, here.tolist(), there.tolist(), ends, strict=True):
        plain, told = (chaining.alignment(one, two, [x], [y], [1], e) for e in (None, own))
        assert all((p == t).all() for p, t in zip(plain[:2], told[:2])) and plain[2:] == told[2:]


def test_alignment_in_halves(monkeypatch):
    draw = random.Random(14)
    for cells in (chaining.CELLS, 8):
        monkeypatch.setattr(chaining, "CELLS", cells)
        for _ in range(200):
            a, b = (np.array([draw.randrange(4) for _ in range(draw.randint(1, 14))]) for _ in range(2))
            x, y = chaining.common_places(a, b)
            assert len(x) == chaining.common_words(a, b) and (a[x] == b[y]).all()
            assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()


def test_common_words():
    draw = random.Random(8)
    for _ in range(200):
        a, b = (np.array([draw.randrange(4) for _ in range(draw.randint(1, 12))]) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert chaining.common_words(a, b) == table[-1][-1]


def test_contained_items(table, messy, empty):
    items = [(k, brute.prose(80 + k, 15 + 3 * k)) for k in range(10)] + [(90, None), (91, " !"), (92, "qqq")]
    draw, docs, truth = random.Random(9), [], set()
    for k in range(120):
        item, text = items[k % 10]
        n = len(text.split())
        inside = brute.edited(text.replace("\n", ""), k, draw.randint(0, max(0, int(0.2 * n) - 1)))
        docs.append((k, f"{brute.prose(900 + k, 60)}. {inside.upper() if k % 3 else inside}, {brute.prose(1100 + k, 30)}"))
    docs += [(500 + k, brute.prose(1300 + k, 150)) for k in range(30)]
    bench = table(items, "item_id long, text string")
    found = embedding_lsh.contained_items(table(docs, "doc_id long, text string"), bench).collect()
    truth = {(k, i) for k, t in docs for i, text in items[:10] if brute.contains(t, text)}
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got <= truth and len(got) >= 0.97 * len(truth) and len(truth) >= 120
    exact = {(k, k % 10) for k in range(120) if f" {' '.join(embedding_lsh_words(items[k % 10][1]))} " in f" {' '.join(embedding_lsh_words(docs[k][1]))} "}
    assert exact <= got
    assert embedding_lsh.contained_items(messy, bench).collect() == []
    assert embedding_lsh.contained_items(empty, bench).collect() == [] and embedding_lsh.contained_items(messy, bench.limit(0)).collect() == []
    own = messy.sparkSession.createDataFrame([(1, BASE)], "item_id long, text string")
    assert sorted(r["doc_id"] or -1 for r in embedding_lsh.contained_items(messy, own).collect()) == [-1, 1, 1, 7, 8]


def embedding_lsh_words(text):
    return [w.decode() for w in embedding_lsh.plain_words(text)]


@pytest.mark.parametrize("kinds", ["d", "i", "sdi"])
def test_items_with_words_put_in_and_left_out(table, kinds):
    item = brute.prose(77, 50).replace("\n", "")
    docs = [(k, f"{brute.prose(2000 + k, 40)} {brute.moved(item, k, 8, kinds)} {brute.prose(2100 + k, 40 if k % 3 else 1)}") for k in range(60)]
    docs += [(100, brute.moved(item, 5, 8, "d")), (101, item)]
    assert all(brute.contains(t, item) for _, t in docs)
    found = embedding_lsh.contained_items(table(docs, "doc_id long, text string"), table([(1, item)], "item_id long, text string")).collect()
    assert len(found) >= 0.97 * len(docs) and all(r["edits"] <= 10 for r in found)


def test_items_in_several_groups_give_the_same(table, monkeypatch):
    items = [(k, brute.prose(80 + k, 20)) for k in range(6)]
    docs = [(k, f"a {items[k % 6][1]} b") for k in range(12)]
    monkeypatch.setattr(embedding_lsh, "ITEM_BYTES", 200)
    found = embedding_lsh.contained_items(table(docs, "doc_id long, text string"), table(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} >= {(k, k % 6) for k in range(12)}


def test_only_likely_windows_are_hashed_and_compared(monkeypatch):
    item = [f"i{k}" for k in range(50)]
    texts = [" ".join([*(f"w{n}x{k}" for k in range(100)), *item[:-2], f"e{n}", "end"]) for n in range(20)]
    texts += [" ".join(f"other{n}x{k}" for k in range(100)) for n in range(20)]
    items, calls = embedding_lsh.Items([(1, " ".join(item))], 0.2, embedding_lsh.walks_needed(0.99)), []
    plain = embedding_lsh.best_prefix
    monkeypatch.setattr(embedding_lsh, "best_prefix", lambda a, b, limit: calls.append(limit) or plain(a, b, limit))
    assert sorted(items.search(texts)) == [(n, 1, 100, 2) for n in range(20)]
    assert len(calls) <= 10 * 20
    assert not any(w.startswith(b"other") for w in items.hashes)


def test_word_edit_distance():
    draw = random.Random(5)
    for _ in range(2000):
        a, b = ([draw.choice("abc") for _ in range(draw.randint(0, 8))] for _ in range(2))
        for limit in range(5):
            assert min(embedding_lsh.best_prefix(a, b, limit), limit + 1) == min(limit + 1, *(brute.edit_distance(a, b[:k]) for k in range(len(b) + 1)))


@pytest.mark.parametrize("width", [24, 50])
def test_repeated_bytes(table, width):
    draw = random.Random(width)
    parts = ["".join(draw.choices("abé", k=draw.randint(10, 90))) for _ in range(12)]
    docs = [(k, "".join(draw.choices(parts, k=draw.randint(0, 4)))) for k in range(60)] + [(70, "a" * 200), (71, "a" * 30), (72, "b" + "a" * 120), (73, None)]
    found = {
        r["doc_id"]: (r["n_bytes"], sum(s["stop"] - s["start"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"]))
        for r in without_earlier_strings(table(docs, "doc_id long, text string"), width=width).collect()
    }
    assert found == brute.repeated_bytes(docs, width)


def test_repeated_bytes_of_messy_rows(messy, empty):
    found = sorted((r["doc_id"] or -1, r["n_bytes"], bytes(r["kept"])) for r in without_earlier_strings(messy).collect())
    assert len(found) == len(MESSY)
    assert [len(kept) == size for k, size, kept in found if k in (-1, 1)] == [True] * 4 and [kept for k, _, kept in found if k == 8] == [b""]
    assert without_earlier_strings(empty).collect() == []


def test_packing(table, messy, empty):
    draw = random.Random(7)
    texts = ["x" * draw.randint(1, 400) + str(k) for k in range(300)] + ["big" * 200] * 150
    docs = [(k, t) for k, t in enumerate(texts)]
    found = bin_packing.packed(table(docs, "doc_id long, text string"), 5).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(len(docs)))
    shards, sizes, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for r in found:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text.encode()))
        shards[text].add(r["shard"])
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in shards.values()) and set(sizes) == set(range(5))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    alone = shards["big" * 200].pop()
    rest = [v for k, v in sizes.items() if k != alone]
    assert max(rest) - min(rest) < 0.02 * max(rest)
    assert bin_packing.packed(messy, 4).count() == len(MESSY) and bin_packing.packed(empty, 4).collect() == []


def test_best_fit_places_as_one_by_one():
    draw = random.Random(11)
    for _ in range(100):
        runs = sorted(((draw.randint(1, 30), draw.randint(1, 6)) for _ in range(8)), reverse=True)
        free, taken = [], []
        for size, count in runs:
            for _ in range(count):
                fits = sorted((space, k) for k, space in enumerate(free) if space >= size)
                if not fits:
                    free.append(40)
                    fits = [(40, len(free) - 1)]
                free[fits[0][1]] -= size
                taken.append(fits[0][1])
        placed = bin_packing.best_fit(runs, 40)
        assert [number for _, number, items in placed for _ in range(items)] == taken


def test_resampling(table, messy, empty):
    good = [(k, brute.prose(2000 + k, 60)) for k in range(80)]
    bad = [(100 + k, " ".join(random.Random(k).choices(["SPAM", "BUY!!", "NOW", "$$$"], k=60))) for k in range(40)]
    docs = table(good + bad, "doc_id long, text string")
    target = table([(k,) for k in range(40)] + [(None,)], "doc_id long")
    first, again = (importance.resampled(docs, target, 2 / 3).orderBy("doc_id").collect() for _ in range(2))
    assert first == again and sum(r["kept"] for r in first) == 80
    assert sum(r["kept"] for r in first if r["doc_id"] < 100) >= 76
    weights = [r["log_weight"] for r in first]
    hashes = importance.WordHashes()
    buckets = [importance.ngram_buckets(t, hashes) for _, t in good + bad]
    one, raw = (sum(np.bincount(b, minlength=importance.BUCKETS) for b in part) + 1.0 for part in (buckets[:40], buckets))
    ratio = np.log(one / one.sum()) - np.log(raw / raw.sum())
    assert weights == pytest.approx([ratio[b].sum() for b in buckets])
    found = importance.resampled(messy, target, 0.5).collect()
    assert len(found) == len(MESSY) and sum(r["kept"] for r in found) >= round(0.5 * len(MESSY))
    assert importance.resampled(empty, target, 0.5).collect() == []


def test_top_k_boundary(table):
    draw = random.Random(12)
    rows = [(k, draw.choice([1.0, 2.0, draw.random(), draw.gauss(0, 1e6)])) for k in range(400)]
    df = table(rows, "id long, v double")
    for share in (0.0, 0.01, 0.3, 0.9, 1.0):
        limit, last = importance.top_k_boundary(df, "v", "id", share, fan=8)
        kept = {k for k, v in rows if limit is not None and (v > limit or (v == limit and k <= last))}
        assert kept == {k for k, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[: round(share * 400)]}
