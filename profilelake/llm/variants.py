"""Spelling variants by blocked Gram matrices of letter counts.

Two words one edit apart (one code point inserted, deleted or replaced) have letter-count vectors at
squared distance 1 or 2 and lengths at most one apart. Words are grouped in blocks by length and by
the counts of letters in ``GROUPS`` fixed groups of the alphabet; a block meets only the blocks
that can hold a word one edit away (see ``near_pairs``). A big block is cut into tiles of about
``TILE`` words by a hash. In a tile pair the squared distances of all its words come from NumPy
matrix products, ``|a|^2 + |b|^2 - 2 a.b``; pairs at most two apart are verified by an exact edit
test. No pair of words is ever a row before it is verified, and a block that holds most words is
spread over many tiles and tasks.

Fixed by the contract: runs ``[A-Za-z\\u00C0-\\u00FF]+``, lower case for A-Z only, the deletion of
code point ``h % length`` where 31 divides ``h = crc32("<doc_id>:<run>")``, words of at least 7 code
points seen at least twice, and forms at least 10 times as frequent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import stored

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10

#: Letters a word can hold after lower-casing: a-z and U+00C0..U+00FF.
ALPHABET = LOWER + "".join(chr(c) for c in range(0xC0, 0x100))
_INDEX = np.full(0x100, -1, np.int64)
for _i, _c in enumerate(ALPHABET):
    _INDEX[ord(_c)] = _i

#: Words of a block per tile, about; a tile pair's products go 2048 x 2048 doubles (32 MB) at a time.
TILE = 8192
PART = 2048
#: Words of the tile pairs that share one Python call, about.
GROUP_WORDS = 65536
#: Letter groups of a block's key: the letter at place p of ``ALPHABET`` is in group p % GROUPS.
GROUPS = 4
_GROUP_LETTERS = ["".join(c for i, c in enumerate(ALPHABET) if i % GROUPS == g) for g in range(GROUPS)]


def _offsets(groups: int) -> list[tuple]:
    """Steps (length, counts of all groups but the last) from a block to its partners."""
    out = [(0,) * groups]
    unit = [tuple(int(k == g) for k in range(groups)) for g in range(groups)]
    for g in range(groups):  # insertion of a letter of group g
        out.append((1, *unit[g][:-1]))
    for a in range(groups):  # replacement: a count moves from group b to an earlier group a
        for b in range(a + 1, groups):
            moved = tuple(unit[a][k] - unit[b][k] for k in range(groups))
            out.append((0, *moved[:-1]))
    return out


_OFFSETS = _offsets(GROUPS)

_PAIRS = "word string, other string"


def words(documents: DataFrame) -> DataFrame:
    """``word, n``: distinct runs after the contract's deletion, with their number of occurrences.

    A null text has no runs; a null doc_id stands as the empty text in the hash. Every occurrence
    counts, repeated rows too.
    """
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"),
        F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), 0)).alias("raw"),
    ).select("d", F.translate("raw", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("d", F.lit(":"), "run").cast("binary"))
    k = (h % F.length("run")).cast("int")
    cut = F.when(h % DROP_EVERY == 0,
                 F.concat(F.expr("substring(run, 1, k)"), F.expr("substring(run, k + 2)")))
    shaped = runs.withColumn("k", k).select(F.coalesce(cut, F.col("run")).alias("word"))
    counted = shaped.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def one_edit(a: str, b: str) -> bool:
    """True if ``b`` is ``a`` with exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    return a[i:] == b[i + 1:]


def _counts(texts: list[str]) -> np.ndarray:
    """Letter counts of words, one row each, from one pass over all their code points."""
    width = len(ALPHABET)
    if not texts:
        return np.zeros((0, width), np.float64)
    lengths = np.fromiter((len(w) for w in texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    cells = np.repeat(np.arange(len(texts)) * width, lengths) + _INDEX[np.minimum(codes, 0xFF)]
    return np.bincount(cells, minlength=len(texts) * width).reshape(len(texts), width).astype(np.float64)


def _codes(texts: list[str], width: int) -> np.ndarray:
    """Code points of words, one zero-padded row each."""
    out = np.zeros((len(texts), width), np.uint32)
    if texts:
        lengths = np.fromiter((len(w) for w in texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        out[np.repeat(np.arange(len(texts)), lengths),
            np.arange(len(codes)) - np.repeat(starts, lengths)] = codes
    return out


def _one_edit_many(a: np.ndarray, la: int, b: np.ndarray, lb: int) -> np.ndarray:
    """``one_edit`` of row pairs of two code matrices whose words have lengths la and lb."""
    if la == lb:
        return (a != b).sum(1) == 1
    if abs(la - lb) != 1:
        return np.zeros(len(a), bool)
    short, long_, n = (a, b, la) if la < lb else (b, a, lb)
    same = short[:, :n] == long_[:, :n]
    first = np.where(same.all(1), n, same.argmin(1))
    shifted = short[:, :n] == long_[:, 1:n + 1]
    rest = np.ones((len(a), n + 1), bool)  # rest[:, k]: short[k:] == long[k + 1:]
    rest[:, :n] = np.flip(np.cumprod(np.flip(shifted, 1), 1), 1).astype(bool)
    return rest[np.arange(len(a)), first]


def _tile_pair(left: list[str], right: list[str], same: bool, a: list, b: list) -> None:
    """Near pairs of one tile pair, appended to ``a`` and ``b``.

    All words of a side have one length (that of their block). Squared distances come from
    products of letter counts, ``PART`` x ``PART`` at a time; candidates at most two apart are
    verified by the exact edit test on code-point matrices, all at once.
    """
    if not left or not right:
        return
    la, lb = len(left[0]), len(right[0])
    cl, cr = _counts(left), _counts(right)
    # only letters that occur; single precision is exact while squared norms stay below 2**24
    used = (cl.any(0) | cr.any(0))
    kind = np.float32 if max(la, lb) <= 4096 else np.float64
    cl, cr = cl[:, used].astype(kind), cr[:, used].astype(kind)
    nl, nr = (cl * cl).sum(1), (cr * cr).sum(1)
    wl, wr = _codes(left, la), _codes(right, lb)
    for x in range(0, len(left), PART):
        for y in range(x if same else 0, len(right), PART):
            dist = nl[x:x + PART, None] + nr[None, y:y + PART] - 2.0 * (cl[x:x + PART] @ cr[y:y + PART].T)
            cand = dist <= 2.0
            if same and x == y:
                cand = np.triu(cand, 1)
            i, j = np.nonzero(cand)
            ok = _one_edit_many(wl[x + i], la, wr[y + j], lb)
            a.extend(left[k] for k in x + i[ok])
            b.extend(right[k] for k in y + j[ok])


def _tile_pairs(group: pa.Table) -> pa.Table:
    """Near pairs of all tile pairs of a group (``pid`` names one; side 0 left, 1 right, 2
    both, for a tile with itself)."""
    pid = group["pid"].to_numpy()
    side = group["side"].to_numpy()
    words = group["word"].to_pylist()
    order = np.lexsort((side, pid))
    cuts = np.flatnonzero(np.diff(pid[order])) + 1
    a, b = [], []
    for part in np.split(order, cuts):
        if not len(part):
            continue
        sides = side[part]
        if (sides == 2).any():
            both = [words[k] for k in part]
            _tile_pair(both, both, True, a, b)
        else:
            _tile_pair([words[k] for k in part[sides == 0]], [words[k] for k in part[sides == 1]],
                       False, a, b)
    return pa.table({"word": pa.array(a, pa.string()), "other": pa.array(b, pa.string())})


def near_pairs(vocab: DataFrame) -> DataFrame:
    """Unordered pairs ``word, other`` of ``vocab`` words one edit apart, each once.

    A block holds the words of one length and one count of letters in each of ``GROUPS``
    groups of the alphabet. An insertion adds one to the length and to one group's count; a
    replacement moves one count from a group to another, or none. So a block meets itself, the
    blocks of the next length with one count more, and those of its length with one count moved
    up the order of groups: at most 1 + G + G (G - 1) / 2 blocks, those that exist. A block of
    more than ``TILE`` words is cut into tiles by a hash, and every tile meets every tile of its
    partner.
    """
    sig = [F.length("word").alias("len")] + [
        F.length(F.regexp_replace("word", f"[^{letters}]", "")).alias(f"g{g}")
        for g, letters in enumerate(_GROUP_LETTERS[:-1])]
    keys = ["len"] + [f"g{g}" for g in range(GROUPS - 1)]
    placed = vocab.select("word", *sig)
    blocks = stored(placed.groupBy(*keys).count(), "variants-blocks")
    tiles = blocks.select(*keys, F.greatest(F.lit(1), F.ceil(F.col("count") / TILE)).cast("int").alias("t"),
                          "count")
    placed = placed.join(F.broadcast(tiles), keys).select(
        "word", *keys, F.pmod(F.xxhash64("word"), F.col("t")).cast("int").alias("tile"))
    # partner blocks by offsets of (len, g0, g1, ...); the last group's count follows from the length
    steps = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(o)]) for o in _OFFSETS])
    mine = tiles.select(*keys, "t", "count", F.explode(steps).alias("o"))
    partner = mine.select(
        *[F.col(k).alias(f"a_{k}") for k in keys], F.col("t").alias("a_t"), F.col("count").alias("a_n"),
        *[(F.col(k) + F.col(f"o.d{i}")).alias(f"b_{k}") for i, k in enumerate(keys)],
        (sum(F.abs(F.col(f"o.d{i}")) for i in range(len(keys))) == 0),
    ).toDF(*[f"a_{k}" for k in keys], "a_t", "a_n", *[f"b_{k}" for k in keys], "diag")
    other = tiles.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col("t").alias("b_t"),
                         F.col("count").alias("b_n"))
    block_pairs = partner.join(other, [f"b_{k}" for k in keys])
    pairs = stored(block_pairs.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("a_t") - 1)).alias("i")).select(
        "*", F.explode(F.sequence(F.when(F.col("diag"), F.col("i")).otherwise(0), F.col("b_t") - 1)).alias("j")
    ).withColumn("words", F.col("a_n") / F.col("a_t") + F.when(F.col("diag"), 0).otherwise(F.col("b_n") / F.col("b_t")))
        .drop("a_t", "b_t", "a_n", "b_n").withColumn("pid", F.monotonically_increasing_id()),
        "variants-tilepairs")
    # Many small tile pairs share one group, so that a Python call has work enough; a group
    # holds about GROUP_WORDS words, a tile pair at most 2 TILE.
    total = pairs.agg(F.sum("words")).first()[0] or 0
    groups = max(1, int(-(-total // GROUP_WORDS)))
    diag_tile = F.col("diag") & (F.col("i") == F.col("j"))
    bucket = F.pmod(F.xxhash64("pid"), F.lit(groups)).alias("bucket")
    left_on = [placed[k] == pairs[f"a_{k}"] for k in keys] + [placed["tile"] == pairs["i"]]
    right_on = [placed[k] == pairs[f"b_{k}"] for k in keys] + [placed["tile"] == pairs["j"]]
    as_left = placed.join(pairs, left_on).select(
        bucket, "pid", "word", F.when(diag_tile, 2).otherwise(0).alias("side"))
    as_right = placed.join(pairs, right_on).where(~diag_tile).select(
        bucket, "pid", "word", F.lit(1).alias("side"))
    return as_left.unionByName(as_right).groupBy("bucket").applyInArrow(_tile_pairs, _PAIRS)


def variants(documents: DataFrame) -> DataFrame:
    """Every word with its form and root.

    Returns ``word, form, root, n, n_near, form_n``. ``form`` is the near word of largest n (ties:
    the smallest in code-point order) if its n is at least ten times the word's, else null; ``root``
    follows forms to the last (the word itself if it has no form). An empty table, or one
    without words, gives no rows. Only ``doc_id`` and ``text`` are read; other columns are ignored.
    """
    vocab = stored(words(documents.select("doc_id", "text")), "variants-words")
    pairs = stored(near_pairs(vocab), "variants-pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    counts = vocab.select(F.col("word").alias("other"), F.col("n").alias("on"))
    best = both.join(counts, "other").groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("on")).alias("neg"), F.col("other").alias("w"))).alias("b"))
    table = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.neg") >= FORM_RATIO * F.col("n"), F.col("b.w")).alias("form"),
        F.when(-F.col("b.neg") >= FORM_RATIO * F.col("n"), -F.col("b.neg")).alias("form_n"))
    table = stored(table.withColumn("root", F.coalesce("form", "word")), "variants-forms")
    # Pointer doubling: a root's root, until none moves. A form is ten times as frequent as its
    # word, so chains are short and the loop ends after a few rounds.
    while True:
        step = table.alias("t").join(
            table.select(F.col("word").alias("r"), F.col("root").alias("rr")).alias("u"),
            F.col("t.root") == F.col("u.r"), "left")
        moved = step.where(F.col("rr").isNotNull() & (F.col("rr") != F.col("t.root")))
        if moved.limit(1).count() == 0:
            break
        table = stored(step.select("word", "n", "n_near", "form", "form_n",
                                   F.coalesce("rr", F.col("t.root")).alias("root")), "variants-roots")
    return table.select("word", "form", "root", "n", "n_near", F.col("form_n").cast("long"))


def brute_force(rows: list[tuple]) -> list[tuple]:
    """The contract in plain Python over ``(doc_id, text)`` rows, for tests."""
    import re
    import zlib
    from collections import Counter

    count = Counter()
    for doc, text in rows:
        for run in re.findall(RUN, text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % DROP_EVERY == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= MIN_LENGTH:
                count[run] += 1
    vocab = {w: n for w, n in count.items() if n >= MIN_COUNT}
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, n in vocab.items():
        if near[w]:
            b = min(near[w], key=lambda v: (-vocab[v], v))
            form[w] = b if vocab[b] >= FORM_RATIO * n else None
        else:
            form[w] = None
    out = []
    for w, n in vocab.items():
        r = w
        while form[r] is not None:
            r = form[r]
        f = form[w]
        out.append((w, f, r, n, len(near[w]), vocab[f] if f else None))
    return out
