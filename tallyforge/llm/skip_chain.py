"""Personal data by a skip-chain conditional random field: tokens that repeat in a document share their label."""

from __future__ import annotations

import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import mapped
from tallyforge.session import stage_table

# The kinds, in the order in which spans are listed.
KINDS = ["email", "ip", "card", "phone"]
LABELS = len(KINDS) + 1
_OPEN = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A run of digits is entered at its start only: what fails there fails inside it as well.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Words before and after a token are numbered by a hash up to this.
CONTEXT = 256
_FORM = 27
_FAILS = 26
FEATURES = _FORM + 2 * CONTEXT


def _luhn(digits: str) -> bool:
    tail = [int(d) for d in reversed(digits)]
    return (sum(tail[::2]) + sum(sum(divmod(2 * d, 10)) for d in tail[1::2])) % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """``start, kind, end`` of what the patterns find, in order, and of matches dropped for their digits; linear in the text."""
    found, dropped, done, at = [], [], 0, text.find("@")
    while at >= 0:
        # The characters before the sign, as far as no earlier address took them.
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            found.append((start, 0, host.end()))
        done = host.end() if host else at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        fits = all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
        (found if fits else dropped).append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        (found if 12 <= len(digits) <= 19 and _luhn(digits) else dropped).append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        fits = 9 <= sum(c in "0123456789" for c in m.group()) <= 15
        (found if fits else dropped).append((m.start(), 3, m.end()))
    return sorted(found), sorted(d for d in dropped if " " in text[d[0] : d[2]])


class Tokens:
    """The tokens of one text that may be personal data, the potentials they share, and what is known of them.

    A token is a word with a digit or an at sign, without the marks around it. Neighbours stand in adjacent words.
    Two tokens are similar if they have the same letters and digits, the same last seven digits, or the same letters
    before an at sign; each is tied to the next similar one only, so that a token repeated often makes a chain, not all pairs.
    """

    def __init__(self, text: str, found: list[tuple[int, int, int]], dropped: list[tuple[int, int, int]]):
        #: Inside a dropped match of several words, so the patterns do not tell what the token is.
        self.unsure: list[bool] = []
        self.starts: list[int] = []
        self.stops: list[int] = []
        self.labels: list[int] = []
        self.features: list[list[int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        last: dict[tuple, int] = {}
        before, before_open, waiting = "", -1, None
        at, doubt = 0, 0
        for m in _WORD.finditer(text):
            word = m.group()
            if waiting is not None:
                self.features[waiting].append(_FORM + CONTEXT + crc32(word[:24].lower().encode()) % CONTEXT)
                waiting = None
            if not _OPEN.search(word):
                before, before_open = word, -1
                continue
            start, stop = m.start(), m.end()
            while not (text[start].isalnum() or text[start] in "+(@"):
                start += 1
            while not (text[stop - 1].isalnum() or text[stop - 1] in ")@"):
                stop -= 1
            node = len(self.starts)
            while at < len(found) and found[at][2] <= start:
                at += 1
            # The first kind, by start, that covers a part of the token.
            covering = next((k for a, k, b in found[at : at + 8] if a < stop and b > start), None)
            while doubt < len(dropped) and dropped[doubt][2] <= start:
                doubt += 1
            self.unsure.append(covering is None and any(a < stop and b > start for a, _, b in dropped[doubt : doubt + 8]))
            self.starts.append(start)
            self.stops.append(stop)
            self.labels.append(0 if covering is None else covering + 1)
            self.features.append([*_form(text[start:stop], before_open >= 0), _FORM + crc32(before[-24:].lower().encode()) % CONTEXT])
            if before_open >= 0:
                self.chain.append((before_open, node))
                self.features[before_open].append(24)
            for key in _similar(text[start:stop]):
                if key in last:
                    self.skip.append((last[key], node))
                last[key] = node
            before, before_open, waiting = word, node, node
        self.skip = sorted(set(self.skip))


def _form(token: str, beside: bool) -> list[int]:
    """Features of the token itself: all are yes-or-no, given by their numbers."""
    plain = "".join(c for c in token if c in "0123456789")
    digits = len(plain)
    dots = token.count(".")
    letters = [c for c in token if c.isalpha()]
    made = [0, 1 + next(k for k, most in enumerate((0, 2, 4, 6, 8, 11, 15, 19, len(token))) if digits <= most), 11 + min(dots, 4)]
    made += [10] if "@" in token else []
    made += [16] if token[0] == "+" else []
    made += [17] if "(" in token or ")" in token else []
    made += [18] if "-" in token else []
    made += [19] if any(c in "/:=\"'_#$%&*" for c in token) else []
    made += [22 if any(c not in "abcdefABCDEF" for c in letters) else 21] if letters else [20]
    made += [25 if _luhn(plain) else _FAILS] if 12 <= digits <= 19 else []
    return made + ([23] if beside else [])


def _similar(token: str) -> list[tuple]:
    plain = "".join(c for c in token.lower() if c.isalnum())
    digits = "".join(c for c in token if c in "0123456789")
    keys = [("all", plain)] if len(plain) >= 3 else []
    keys += [("tail", digits[-7:])] if len(digits) >= 7 else []
    name = token.lower().partition("@")[0] if "@" in token else ""
    return keys + ([("name", name)] if len(name) >= 3 else [])


class Field:
    """Weights of the features, of neighbouring labels (left, right) and of the labels of similar tokens."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, scores: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = 30, tolerance: float = 1e-4) -> np.ndarray:
        """Chances of the labels of all tokens by loopy message passing; exact where the graph is a forest.

        ``scores`` holds the score of each label of each token, -inf for labels that are known to be wrong. Messages of
        all edges are sent at once, and each is mixed with the one before it so that loops settle.
        """
        edges = np.concatenate([chain, skip]).reshape(-1, 2)
        table = np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)])
        source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
        table = np.concatenate([table, table.transpose(0, 2, 1)])
        back = np.r_[len(edges) : 2 * len(edges), 0 : len(edges)]
        sent = np.zeros((len(source), LABELS))
        scores = np.maximum(scores, -1e6)

        def beliefs():
            total = scores.copy()
            for k in range(LABELS):
                total[:, k] += np.bincount(target, sent[:, k], len(scores))
            return total

        for _ in range(rounds if len(edges) else 0):
            held = beliefs()[source] - sent[back]
            new = _log_sum(held[:, :, None] + table, 1)
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - sent).max()
            sent = 0.5 * sent + 0.5 * new if moved > tolerance else new
            if moved <= tolerance:
                break
        total = beliefs()
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fitted(features: list[list[int]], labels: np.ndarray, left: np.ndarray, right: np.ndarray, similar: np.ndarray, steps: int = 150) -> Field:
    """The field with the best pseudo-likelihood: each label given its features and the labels beside and similar to it.

    ``left`` and ``right`` are labels or -1, ``similar`` counts of the labels of similar tokens. Weights are drawn
    to zero a little; steps follow the gradient, scaled by its running size.
    """
    counts = np.array([len(f) for f in features])
    place, number = np.repeat(np.arange(len(features)), counts), np.concatenate([np.array(f) for f in features]).astype(np.int64)
    from_left, from_right = np.eye(LABELS + 1)[left][:, :LABELS], np.eye(LABELS + 1)[right][:, :LABELS]
    wanted = np.eye(LABELS)[labels]
    weights = [np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
    speed = [np.zeros_like(w) for w in weights]
    size = [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        unary, chain, skip = weights
        scores = from_left @ chain + from_right @ chain.T + similar @ skip
        for k in range(LABELS):
            scores[:, k] += np.bincount(place, unary[number, k], len(features))
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        gap = (wanted - scores / scores.sum(axis=1, keepdims=True)) / len(features)
        up = np.stack([np.bincount(number, gap[place, k], FEATURES) for k in range(LABELS)], axis=1)
        tied = similar.T @ gap
        for k, slope in enumerate((up, from_left.T @ gap + gap.T @ from_right, (tied + tied.T) / 2)):
            slope = slope - 1e-5 * weights[k]
            speed[k] = 0.9 * speed[k] + 0.1 * slope
            size[k] = 0.99 * size[k] + 0.01 * slope * slope
            weights[k] = weights[k] + 0.1 * (speed[k] / (1 - 0.9**step)) / (np.sqrt(size[k] / (1 - 0.99**step)) + 1e-8)
    return Field(*weights)


_SITE = pa.schema([
    ("draw", pa.int64()), ("features", pa.list_(pa.int32())), ("label", pa.int32()), ("left", pa.int32()), ("right", pa.int32()), ("similar", pa.list_(pa.int32())),
])


def _sites(piece: pa.RecordBatch) -> dict | None:
    """Each token that the patterns judge, with its label and those of the tokens that it shares potentials with."""
    made: dict[str, list] = {f.name: [] for f in _SITE}
    for text in piece.column("text").to_pylist():
        if not text or not _OPEN.search(text):
            continue
        tokens = Tokens(text, *base_spans(text))
        count = len(tokens.labels)
        for a, b in tokens.skip:
            for one, other in ((a, b), (b, a)):
                tokens.unsure[one] |= not tokens.labels[one] and tokens.labels[other] > 0
        sure = [k for k, unsure in enumerate(tokens.unsure) if not unsure]
        left, right, similar = [-1] * count, [-1] * count, np.zeros((count, LABELS), np.int32)
        for a, b in tokens.chain:
            right[a], left[b] = (-1 if tokens.unsure[k] else tokens.labels[k] for k in (b, a))
        for a, b in tokens.skip:
            similar[a, tokens.labels[b]] += not tokens.unsure[b]
            similar[b, tokens.labels[a]] += not tokens.unsure[a]
        own = sha256(text.encode()).digest()[:8]
        draws = [int.from_bytes(sha256(own + k.to_bytes(8, "little")).digest()[:8], "little") >> 2 for k in range(count)]
        for name, value in zip(made, (draws, tokens.features, tokens.labels, left, right, similar.tolist())):
            made[name].extend(value[k] for k in sure)
    return made if made["label"] else None


def fit(docs: DataFrame, text: str = "text", fit_sites: int = 50_000) -> Field | None:
    """The field fitted on about ``fit_sites`` tokens (never more than twice as many), chosen by a hash of text and place.

    Labels are those of the patterns. Without a token that the patterns label there is nothing to learn: None.
    """
    rows = docs.select(F.col(text).alias("text"))
    ddl = "draw long, features array<int>, label int, left int, right int, similar array<int>"
    sites = stage_table(rows.mapInArrow(mapped(_sites, "text", _SITE), ddl), "sites")
    count = sites.count()
    drawn = sites.filter(F.col("draw") < int(min(1.0, fit_sites / max(1, count)) * (1 << 62))).limit(2 * fit_sites)
    found = drawn.orderBy("draw").toArrow()
    labels = found.column("label").to_numpy()
    if not labels.any():
        return None
    similar = np.array(found.column("similar").to_pylist(), float)
    return fitted(found.column("features").to_pylist(), labels, found.column("left").to_numpy(), found.column("right").to_numpy(), similar)


def added_spans(fields: Field, tokens: list[Tokens], confidence: float) -> list[list[tuple[int, int, int]]]:
    """For each text the runs of neighbouring tokens outside the patterns that are one kind with the given chance."""
    offsets = np.cumsum([0, *(len(t.labels) for t in tokens)])
    if not offsets[-1]:
        return [[] for _ in tokens]
    features = [f for t in tokens for f in t.features]
    place = np.repeat(np.arange(len(features)), [len(f) for f in features])
    number = np.concatenate([np.array(f) for f in features]).astype(np.int64)
    scores = np.stack([np.bincount(place, fields.unary[number, k], len(features)) for k in range(LABELS)], axis=1)
    # Digits that fail the check are no card, whatever stands beside them.
    scores[place[number == _FAILS], 1 + KINDS.index("card")] = -np.inf
    known = np.concatenate([np.array(t.labels, np.int64) for t in tokens])
    sure = np.flatnonzero(known)
    held = scores[sure, known[sure]]
    scores[sure] = -np.inf
    scores[sure, known[sure]] = held
    chain, skip = (
        np.concatenate([np.array(getattr(t, name), np.int64).reshape(-1, 2) + start for t, start in zip(tokens, offsets)]) for name in ("chain", "skip")
    )
    chances = fields.marginals(scores, chain, skip)
    best = np.where(chances.max(axis=1) >= confidence, chances.argmax(axis=1), 0)
    best[sure] = 0
    made = []
    for t, start in zip(tokens, offsets):
        beside, runs = {b for a, b in t.chain}, []
        for k, kind in enumerate(best[start : start + len(t.labels)].tolist()):
            if not kind:
                continue
            if k in beside and runs and runs[-1][3] == k - 1 and runs[-1][1] == kind - 1:
                runs[-1] = (runs[-1][0], kind - 1, t.stops[k], k)
            else:
                runs.append((t.starts[k], kind - 1, t.stops[k], k))
        made.append([r[:3] for r in runs])
    return made


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop in sorted(spans))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", confidence: float = 0.9, fit_sites: int = 50_000) -> DataFrame:
    """``key, n_email, n_ip, n_card, n_phone`` (long, of the patterns), ``base, spans`` (strings) of every document.

    The patterns find e-mail and network addresses, card numbers that pass Luhn's check and phone numbers. The field then
    labels the other tokens that hold a digit or an at sign: words with neither are never personal data. Scores of a token
    come from its form and the words beside it; tokens beside each other and similar tokens of the document, however far
    apart, share potentials, and the labels of the patterns are given. Messages are passed over all documents of a batch
    at once. A token whose chance for one kind is at least ``confidence`` is added; neighbours of one kind are one span.
    ``base`` lists the spans of the patterns and ``spans`` all, as ``kind:start:end`` in code points by start and kind.

    The field is fitted here, on the labels of the patterns in about ``fit_sites`` tokens of all documents; tokens in a match of
    several words that was dropped for its digits, and those similar to a token that the patterns found, are left out, as they may
    be what the field is to find. A null or empty text has
    no spans; null and repeated keys are passed on, one row for each row; an empty table gives no rows. Other columns
    are not read. A task holds a batch of some 4 MB of text, or one text if that is longer, with its open tokens.
    """
    kind = docs.schema[key].dataType
    field = fit(docs, text, fit_sites)
    shared = docs.sparkSession.sparkContext.broadcast(field and (field.unary, field.chain, field.skip))
    counts = [f"n_{k}" for k in KINDS]
    schema = pa.schema([("key", pa.int64()), *((c, pa.int64()) for c in counts), ("base", pa.string()), ("spans", pa.string())])

    def find(piece: pa.RecordBatch) -> dict:
        texts = piece.column("text").to_pylist()
        opened = [k for k, t in enumerate(texts) if t and _OPEN.search(t)]
        base = {k: base_spans(texts[k]) for k in opened}
        more: dict[int, list] = {}
        if shared.value is not None and opened:
            more = dict(zip(opened, added_spans(Field(*shared.value), [Tokens(texts[k], *base[k]) for k in opened], confidence)))
        made: dict[str, list] = {f.name: [] for f in schema if f.name != "key"}
        for k in range(len(texts)):
            found = base.get(k, ([], []))[0]
            for c, name in enumerate(counts):
                made[name].append(sum(f[1] == c for f in found))
            made["base"].append(_shown(found))
            made["spans"].append(_shown([*found, *more.get(k, [])]))
        return made | {"key": piece.column("key")}

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    found = rows.mapInArrow(mapped(find, "text", schema), f"key long, {', '.join(f'{c} long' for c in counts)}, base string, spans string")
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
