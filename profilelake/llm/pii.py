"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The field has one tag per kind and ``O``. A token's features are its shape, its text if the
labelled table knows it as a cue, and the same of its neighbours. It is trained by gradient
steps on the likelihood of a small labelled table; texts are decoded by Viterbi, all sentences
of a batch side by side in numpy. The patterns stay what they are: spans of the field that touch
one of theirs are left out.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilelake.llm.common import arrow_limits

BASE = ("email", "ip", "card", "phone")
TAGS = ("O", "person", "address", "account", "contact")
#: Words that a span of a kind has at least, and any at most.
SHORTEST = {"person": 2, "address": 3, "account": 1, "contact": 4}
LONGEST = 6
#: Rows of the labelled table that training takes at most.
LABELLED = 5000
STEPS, RATE, PENALTY = 100, 0.15, 0.001
#: Words whose scores a task remembers at most, and characters decoded side by side.
_MEMORY = 300_000
_TOGETHER = 500_000

# ---------------------------------------------------------------------- fixed patterns

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match cannot begin within a run of digits: its start would have matched before
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from the @ outwards."""
    done = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of all pattern matches, by start and kind as listed."""
    found = []
    if "@" in text:
        found += [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], BASE.index(s[2])))


# ---------------------------------------------------------------------- labelled table

_FIRST = "Anna Ben Carla David Elena Frank Grace Henry Ines Jonas Karin Louis Maria Nina Oscar Paula".split()
_LAST = "Alvarez Becker Carter Dupont Evans Fischer Garcia Hansen Ivanov Jensen Keller Lopez".split()
_STREETS = "Street Road Avenue Lane Drive Boulevard Court Square".split()
_SYLLABLES = "an be con der en for ging hea ist ja ko la men non ou pre que re sch ti und ver wh zu é ü ó".split()


def examples(n: int = 1000, seed: int = 7) -> list[tuple[str, list[str], list[str]]]:
    """Made-up labelled sentences: ``(sentence_id, tokens, tags)``.

    Invented words around names after a form of address or an introduction, street addresses,
    account and identity numbers after their names, and written-out addresses of mail boxes;
    and as many sentences without any, with capitals, numbers, dates, marks and the cue words
    in other use.
    """
    r = random.Random(seed)
    word = lambda: "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def plain(k: int) -> list[tuple[str, str]]:
        out = []
        for i in range(k):
            w = word()
            kind = r.random()
            if i == 0 and kind < 0.7 or kind < 0.06:
                w = w.capitalize()
            elif kind < 0.1:
                w = w.upper()
            elif kind < 0.16:
                w = r.choice([digits(r.randint(1, 8)), f"{digits(2)}.{digits(2)}", f"{digits(4)}-{digits(2)}-{digits(2)}",
                              f"{word()}={digits(5)}", f"{word()}|", "|", "-", f"\"{digits(6)}{word()}\""])
            elif kind < 0.22:
                w += r.choice([",", "%%%", "***", "$$$", "!!", ";", "###"])
            elif kind < 0.27:
                w = r.choice("the of at dot to in is number street road name mr id account".split())
            out.append((w, "O"))
        return out

    def tagged(kind: str) -> list[tuple[str, str]]:
        first, last = r.choice(_FIRST), r.choice(_LAST)
        if r.random() < 0.5:  # names are not known by heart
            first, last = word().capitalize(), word().capitalize()
        if kind == "person":
            cue = r.choice(["Mr.", "Mrs.", "Ms.", "Dr.", "name is", "Dear", "signed by"]).split()
            return [(c, "O") for c in cue] + [(first, kind), (last, kind)]
        if kind == "address":
            street = [(word().capitalize(), kind), (r.choice(_STREETS), kind)]
            return [(c, "O") for c in r.choice(["lives at", "address:", "located at"]).split()] + [
                (digits(r.randint(1, 4)), kind), *street]
        if kind == "account":
            number = r.choice([f"{digits(3)}-{digits(2)}-{digits(4)}", f"DE{digits(20)}", f"GB{digits(20)}", digits(9)])
            return [(c, "O") for c in r.choice(["SSN", "SSN:", "IBAN", "IBAN:", "passport no."]).split()] + [(number, kind)]
        box = [first.lower(), r.choice(["at", "(at)", "[at]"]), word(), r.choice(["dot", "(dot)", "[dot]"]), r.choice(["com", "org", "net"])]
        return [(c, "O") for c in r.choice(["mail me:", "write to", "contact:"]).split()] + [(b, kind) for b in box]

    def noise() -> list[tuple[str, str]]:
        """Repeated words, marks on every word, tables, shouting: capitals that name nobody."""
        words = [word().capitalize() if r.random() < 0.5 else word() for _ in range(r.randint(3, 12))]
        style = r.randrange(5)
        if style == 0:
            words = [w for w in words[:3] for _ in range(r.randint(2, 6))]
        elif style == 1:
            words = [w + r.choice(["", ".", ",", ""]) + r.choice(["%%%", "***", "$$$", "###", "&&&"]) for w in words]
        elif style == 2:
            words = [x for w in words for x in (w, "|")]
        elif style == 3:
            words = [w.upper() + r.choice(["!!", ",!!", ""]) for w in words]
        else:
            words = [r.choice(["At", "Of", "To", "Is", "In", "The", "No.", "Con", w]) for w in words]
        return [(w, "O") for w in words]

    rows = []
    for i in range(n):
        tokens = plain(r.randint(2, 9))
        if i % 4 == 0:
            tokens = noise()
        elif i % 2:
            tokens += tagged(TAGS[1 + (i // 2) % (len(TAGS) - 1)]) + plain(r.randint(0, 7))
        tokens[-1] = (tokens[-1][0] + r.choice([".", ".", "", "!"]), tokens[-1][1])
        rows.append((f"s{i}", [t for t, _ in tokens], [t for _, t in tokens]))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    """``examples`` as a table: sentence_id, tokens, tags."""
    return spark.createDataFrame(
        examples(), "sentence_id string, tokens array<string>, tags array<string>")


# ---------------------------------------------------------------------- the field

_EDGES = "\"'.,;:!?()[]{}<>%$#*&|`_"
_ABBREVIATIONS = frozenset(["mr.", "mrs.", "ms.", "dr.", "no.", "st."])
_STEPS = [(re.compile(p), s) for p, s in (
    (r"[0-9]", "d"), (r"[^\W\d_]", "x"), (r"x{2,}", "x"), (r"d{5,8}", "ddddd"), (r"d{9,}", "D"))]


def shape(core: str) -> str:
    """Letters as X or x, runs of them once; digits as d, up to 4 counted; the rest as it is."""
    if core.isalpha():
        return "x" if core.islower() else "Xx" if core[0].isupper() and core[1:].islower() else (
            "X" if core.isupper() else "xX")
    marked = re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", core)
    for pattern, by in (*_STEPS[:1], (re.compile("x{2,}"), "x"), (re.compile("X{2,}"), "X"), *_STEPS[3:]):
        marked = pattern.sub(by, marked)
    return marked[:24]


def features(word: str, cues: frozenset[str] | set[str]) -> tuple[str, ...]:
    core = word.strip(_EDGES)
    known = word.lower() if word.lower() in cues else core.lower() if core.lower() in cues else ""
    return (
        f"s={shape(core)}", f"c={known}",
        f"e={word[len(word.rstrip(_EDGES)):][:1]}{word[:1] if word[:1] in _EDGES else ''}",
    )


@dataclass(frozen=True)
class Crf:
    """Weights: own, previous and next features by name (one number per tag), transitions."""

    cues: frozenset[str]
    weights: dict[str, np.ndarray]
    moves: np.ndarray
    start: np.ndarray

    def scores(self, word: str) -> np.ndarray:
        """What a word adds to the tag scores of itself, of the next and of the word before."""
        names = features(word, self.cues)
        zero = np.zeros(len(TAGS))
        return np.stack([
            np.sum([self.weights.get(f"{place}{f}", zero) for f in names], axis=0)
            for place in ("0", "-", "+")
        ])


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(rows: list[tuple[list[str], list[str]]]) -> Crf:
    """The field of highest penalised likelihood, near enough: full-batch steps of fixed number."""
    k = len(TAGS)
    counts = Counter(w.lower().strip(_EDGES) for tokens, _ in rows for w in set(tokens))
    tagged = Counter(w.lower().strip(_EDGES) for tokens, tags in rows for w, t in zip(tokens, tags)
                     if t == "person")
    cues = frozenset(w for w, n in counts.items() if n >= 8 and w and not tagged[w])
    names: dict[str, int] = {}
    lengths = np.array([len(t) for t, _ in rows])
    n, steps = len(rows), int(lengths.max())
    own = [[features(w, cues) for w in tokens] for tokens, _ in rows]
    entries = []  # (row, step, feature)
    for i, sentence in enumerate(own):
        for t in range(len(sentence)):
            for place, at in (("0", t), ("-", t - 1), ("+", t + 1)):
                if 0 <= at < len(sentence):
                    for f in sentence[at]:
                        entries.append((i, t, names.setdefault(f"{place}{f}", len(names))))
    row, step, feature = np.array(entries).T
    tag_of = {t: j for j, t in enumerate(TAGS)}
    gold = np.zeros((n, steps), int)
    for i, (_, tags) in enumerate(rows):
        gold[i, : len(tags)] = [tag_of[t] for t in tags]
    live = np.arange(steps)[None, :] < lengths[:, None]
    hot = np.eye(k)[gold] * live[..., None]
    pairs = np.einsum("ntj,ntk->jk", hot[:, :-1], hot[:, 1:])

    theta = [np.zeros((len(names), k)), np.zeros((k, k)), np.zeros(k)]
    m1, m2 = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    for turn in range(1, STEPS + 1):
        w, moves, start = theta
        e = np.zeros((n, steps, k))
        np.add.at(e, (row, step), w[feature])
        forward, back = np.zeros((n, steps, k)), np.zeros((n, steps, k))
        forward[:, 0] = start + e[:, 0]
        for t in range(1, steps):
            new = _lse(forward[:, t - 1, :, None] + moves, 1) + e[:, t]
            forward[:, t] = np.where(live[:, t, None], new, forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = _lse(moves + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(live[:, t + 1, None], new, 0)
        z = _lse(forward[:, -1], 1)
        p = np.exp(forward + back - z[:, None, None]) * live[..., None]
        p2 = np.exp(forward[:, :-1, :, None] + moves + (e[:, 1:] + back[:, 1:])[:, :, None, :]
                    - z[:, None, None, None]) * live[:, 1:, None, None]
        g = np.zeros_like(w)
        np.add.at(g, feature, (p - hot)[row, step])
        grads = [g / n + PENALTY * w, (p2.sum((0, 1)) - pairs) / n + PENALTY * moves,
                 (p[:, 0] - hot[:, 0]).mean(0) + PENALTY * start]
        for j, grad in enumerate(grads):
            m1[j] = 0.9 * m1[j] + 0.1 * grad
            m2[j] = 0.999 * m2[j] + 0.001 * grad * grad
            theta[j] = theta[j] - RATE * (m1[j] / (1 - 0.9**turn)) / (
                np.sqrt(m2[j] / (1 - 0.999**turn)) + 1e-8)
    w, moves, start = theta
    return Crf(cues, {f: w[j] for f, j in names.items()}, moves, start)


def viterbi(emissions: np.ndarray, ends: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best tags of all sentences, which lie one after the other and end where ``ends`` is set.

    Sentences go side by side, the longest first, so that those still running at a step are the
    first rows.
    """
    stops = np.flatnonzero(ends) + 1
    begins = np.concatenate(([0], stops[:-1]))
    order = np.argsort(begins - stops, kind="stable")
    begins, lengths = begins[order], (stops - begins)[order]
    running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    best = start + emissions[begins]
    came = np.zeros((len(emissions), emissions.shape[1]), np.int8)
    tags = np.zeros(len(emissions), np.int8)
    for t in range(1, lengths[0]):
        k = running[t]
        paths = best[:k, :, None] + moves
        at = begins[:k] + t
        came[at] = paths.argmax(1)
        best[:k] = paths.max(1) + emissions[at]
    at = begins + lengths - 1
    tags[at] = best.argmax(1)
    for t in range(lengths[0] - 1, 0, -1):
        at = begins[: running[t]] + t
        tags[at - 1] = came[at, tags[at]]
    return tags


class Decoder:
    """Scores of words seen so far, and the decoding of texts."""

    def __init__(self, field: Crf) -> None:
        self.field = field
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, 3, len(TAGS)), np.float32)
        self.ends = np.zeros(1024, bool)

    def _learn(self, words: set[str]) -> None:
        shared: dict[tuple[str, ...], np.ndarray] = {}
        for word in words:
            at = self.rows[word] = len(self.rows)
            if at == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            names = features(word, self.field.cues)
            if names not in shared:
                shared[names] = self.field.scores(word)
            self.table[at] = shared[names]
            self.ends[at] = word[-1] in ".!?" and word.lower() not in _ABBREVIATIONS

    def tags(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Tags of the words of each text; sentences end at their marks and with the text."""
        if len(self.rows) > _MEMORY:
            self.clear()
        words = [w for t in texts for w in t]
        if not words:
            return [np.zeros(0, np.int8) for _ in texts]
        self._learn(set(words).difference(self.rows))
        at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        cuts = np.cumsum([len(t) for t in texts])
        ends = self.ends[at]
        ends[cuts[cuts > 0] - 1] = True
        e = self.table[at, 0].copy()
        inner = ~ends[:-1]
        e[1:][inner] += self.table[at[:-1][inner], 1]
        e[:-1][inner] += self.table[at[1:][inner], 2]
        found = viterbi(e, ends, self.field.moves.astype(np.float32), self.field.start.astype(np.float32))
        return np.split(found, cuts[:-1])

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """Runs of at most LONGEST words of one tag, without the marks around them.

        Runs without a letter or digit, or longer, are noise and left out.
        """
        split = [t.split() for t in texts]
        out = []
        for text, words, tags in zip(texts, split, self.tags(split)):
            found, last, at = [], 0, 0
            for i in np.flatnonzero(tags):
                for w in words[last: i]:
                    at = text.index(w, at) + len(w)
                start = text.index(words[i], at)
                last, at = i + 1, start + len(words[i])
                core = words[i].strip(_EDGES)
                a = start + words[i].index(core)
                kind = TAGS[tags[i]]
                if found and i and tags[i - 1] == tags[i] and found[-1][3] == i - 1:
                    found[-1] = (found[-1][0], a + len(core), kind, i, found[-1][4] + 1)
                else:
                    found.append((a, a + len(core), kind, i, 1))
            out.append([
                (a, b, kind) for a, b, kind, _, n in found
                if b > a and SHORTEST[kind] <= n <= LONGEST
            ])
        return out


def trained(table: DataFrame, limit: int = LABELLED) -> Crf:
    """Fit on at most ``limit`` rows of ``table (sentence_id, tokens, tags)``, by id.

    Rows with null or empty or unequal lists, or with an unknown tag, are passed over.
    """
    known = F.array(*[F.lit(t) for t in TAGS])
    rows = (
        table.where("size(tokens) > 0 and size(tokens) = size(tags)")
        .where(F.forall("tags", lambda t: F.coalesce(F.array_contains(known, t), F.lit(False)))
               & F.forall("tokens", lambda t: t.isNotNull() & (t != "")))
        .orderBy("sentence_id").limit(limit).select("tokens", "tags").collect()
    )
    return _fitted(tuple((tuple(r[0]), tuple(r[1])) for r in rows))


@functools.lru_cache(4)
def _fitted(rows: tuple) -> Crf:
    return fit(list(rows)) if rows else Crf(frozenset(), {}, np.zeros((len(TAGS),) * 2), -np.arange(len(TAGS)))


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def merged(base: list[tuple[int, int, str]], more: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """``base`` and those of ``more`` that touch none of it, by start."""
    free = [s for s in more if not any(s[0] < b and a < s[1] for a, b, _ in base)]
    kinds = (*BASE, *TAGS)
    return sorted(base + free, key=lambda s: (s[0], kinds.index(s[2])))


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size > _TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def _finder(field: Crf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(field)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            more = [s for group in _groups(texts) for s in decoder.spans(group)]
            base = [base_spans(t) for t in texts]
            kinds = [Counter(k for _, _, k in b) for b in base]
            columns = {f"n_{k}": pa.array([c[k] for c in kinds], pa.int64()) for k in BASE}
            columns["base_sha256"] = pa.array(
                [hashlib.sha256(_written(b).encode()).hexdigest() for b in base])
            columns["spans"] = pa.array([_written(merged(b, m)) for b, m in zip(base, more)])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | columns)

    return run


def find(docs: DataFrame, table: DataFrame) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: counts and digest of the pattern spans, and all spans.

    Offsets are code points, ends exclusive. Null texts are empty and have no spans. Repeated
    rows stay rows of their own, null ids stay null, other columns are ignored. An empty
    labelled table leaves the patterns alone.
    """
    arrow_limits(docs.sparkSession)
    field = trained(table)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _finder(field),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
        " spans string",
    )
