"""PII, scoring, toxicity, decontamination and SimHash against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from profilelake.llm import brown, decontaminate, jaccard, pii, queries, simhash, toxicity

LONG = "word " * 30_000


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


# ---------------------------------------------------------------------- personal data

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_base(text):
    out = [(m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.BASE.index(s[2])))


def test_base_patterns_match_plain_ones():
    rng = np.random.default_rng(3)
    pieces = ["a@b.c", "@", "x.y+z@", "..", "1.2.3.4", ".5", "256.1.1.1", "0001.2.3.4", "+1 (499) 555-6503",
              "4040549990366437", "4111 1111-1111 1111", " ", "-", "é", "\n", "+", "(", "12", "a", "@c.d.e"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces, rng.integers(1, 12)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_patterns_are_linear_on_long_runs():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+" + "1 " * 150_000, "@" * 100_000):
        pii.base_spans(text)


def test_field_finds_held_out_labels_and_leaves_prose_alone():
    field = pii.fit([(w, t) for _, w, t in pii.examples()])
    decoder = pii.Decoder(field)
    right = total = wrong = 0
    for _, words, tags in pii.examples(300, seed=99):
        found = [pii.TAGS[t] for t in decoder.tags([words])[0]]
        total += sum(t != "O" for t in tags)
        right += sum(a == b != "O" for a, b in zip(found, tags))
        wrong += sum(a != "O" == b for a, b in zip(found, tags))
    assert right >= 0.9 * total and wrong <= 0.05 * total


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(5)
    moves, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = [1, 4, 2, 5, 1]
    e = rng.normal(size=(sum(lengths), 3))
    ends = np.zeros(len(e), bool)
    ends[np.cumsum(lengths) - 1] = True
    found, at = pii.viterbi(e, ends, moves, start), 0
    for n in lengths:
        best = max(np.ndindex(*[3] * n), key=lambda p: start[p[0]] + sum(
            e[at + i, t] for i, t in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])))
        assert tuple(found[at: at + n]) == best
        at += n


def test_pii_rows(spark, docs_of):
    text = "écrire à ana@x.org. Dear Maria Lopez lives at 12 Baker Street."
    rows = [(1, text), (2, None), (3, ""), (1, text), (None, LONG)]
    found = pii.find(docs_of(rows), pii.labelled_table(spark)).collect()
    assert len(found) == 5
    first = [r for r in found if r.doc_id == 1]
    assert first[0] == first[1] and first[0].n_email == 1
    assert "email:9:18" in first[0].spans.split(",") or "email:9:19" in first[0].spans.split(",")
    assert first[0].base_sha256 == hashlib.sha256(
        ",".join(f"{k}:{a}:{b}" for a, b, k in plain_base(text)).encode()).hexdigest()
    assert all(r.spans == "" and r.n_ip == 0 for r in found if r.doc_id != 1)
    assert pii.find(docs_of([]), pii.labelled_table(spark)).count() == 0


def test_pii_query_on_documents(spark, sf_dir, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in queries.op1_pii(spark, sf_dir).collect():
        base = plain_base(texts[r.doc_id])
        counts = Counter(k for _, _, k in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in pii.BASE)
        written = [f"{k}:{a}:{b}" for a, b, k in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == written


# ---------------------------------------------------------------------- scoring

def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def check_scores(rows, found):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    uses = Counter()
    for i, text in rows:
        if not held(i):
            uses.update(plain_words(text))
            uses[""] += 1
    n, v = sum(uses.values()), len(uses)
    wanted = Counter()
    for i, text in rows:
        tokens = [*plain_words(text), ""]
        base = sum(math.log10((uses[t] + 1) / (n + v + 1)) for t in tokens)
        wanted[(i, held(i), len(tokens), sum(uses[t] > 0 for t in tokens), n, round(base, 6))] += 1
    assert wanted == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)


def test_brown_query_on_documents(spark, sf_dir, documents):
    found = queries.op3_brown(spark, sf_dir).collect()
    check_scores([(r.doc_id, r.text) for r in documents.collect()], found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_brown_looks_up_what_is_not_sent(spark, docs_of, monkeypatch):
    rows = [(i, f"common common rare{i % 5} once{i} Ünique{i}") for i in range(40)] + [
        (None, None), (7, ""), (7, ""), (100, LONG)]
    full = sorted(brown.report(docs_of(rows)).collect(), key=str)
    monkeypatch.setattr(brown, "SENT", 1)
    cut = sorted(brown.report(docs_of(rows)).collect(), key=str)
    check_scores(rows, full)
    check_scores(rows, cut)
    assert brown.report(docs_of([])).count() == 0


def test_brown_is_a_distribution():
    rng = np.random.default_rng(2)
    t = brown.transitions(rng.integers(0, 50, (brown.N_CLASSES, brown.N_CLASSES)).astype(float))
    assert np.allclose(t.sum(axis=1), 1)


def test_exchange_raises_the_likelihood():
    # two kinds of words that alternate: classes that tell them apart are better
    rng = np.random.default_rng(4)
    n = 200
    sequence = np.array([rng.integers(0, n // 2) * 2 + i % 2 for i in range(40_000)])
    classes = np.concatenate([rng.integers(0, brown.CLASSES, brown.EXCHANGED),
                              np.arange(brown.CLASSES, brown.N_CLASSES)])

    def contexts(classes):
        m = np.zeros((brown.N_IDS, 2, brown.N_CLASSES))
        np.add.at(m, (sequence[1:], 0, classes[sequence[:-1]]), 1)
        np.add.at(m, (sequence[:-1], 1, classes[sequence[1:]]), 1)
        return m

    def likelihood(classes):
        counts = np.zeros((brown.N_CLASSES, brown.N_CLASSES))
        np.add.at(counts, classes, contexts(classes)[:, 1])
        return np.log(brown.transitions(counts))[classes[sequence[:-1]], classes[sequence[1:]]].sum() - np.log(
            np.bincount(classes[sequence], minlength=brown.N_CLASSES)[classes[sequence]]).sum()

    before = likelihood(classes)
    for turn in range(6):
        classes = brown.exchange(contexts(classes), classes, turn)
    assert likelihood(classes) > before


# ---------------------------------------------------------------------- toxicity

def test_toxicity_learns_and_does_not_read_labels_of_held_out_rows(spark, docs_of):
    bad = ["scum of the earth", "you idiot", "what a clown"]
    rows = [(i, f"plain words number {i} here " + (bad[i % 3] if i % 4 == 0 else "and more")) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (3, 1, None)],
                                   "doc_id long, quality int, toxic int")
    found = toxicity.report(docs_of([*rows, (401, None), (402, ""), (401, None), (403, LONG)]), labels).collect()
    assert len(found) == 404
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id < 400:
            assert r.predicted == int(r.doc_id % 4 == 0)
    turned = labels.selectExpr(
        "doc_id", "quality", "if(crc32(string(doc_id)) % 4 = 2, 1 - toxic, toxic) toxic")
    again = {r.doc_id: r.score for r in toxicity.report(docs_of(rows), turned).collect()}
    assert all(again[r.doc_id] == r.score for r in found if r.doc_id < 400)


def test_toxicity_without_labels_or_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.report(docs_of([(1, "a")]), none).collect()] == [(0.0, 0)]
    assert toxicity.report(docs_of([]), none).count() == 0


def test_toxicity_keeps_clashing_columns(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "a")]).selectExpr("*", "7 as score", "8 as toxic")
    assert toxicity.accepted(docs, none).collect() == docs.collect()


# ---------------------------------------------------------------------- decontamination

def plain_contamination(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(size, len(v))
            for a in range(len(v) - n + 1) if v else ():
                for b in range(len(w) - n + 1):
                    if w[b: b + n] == v[a: a + n]:
                        hit.update(range(b, b + n))
                        found.add("null" if item is None else str(item))
        ids = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return Counter(out)


CASES = [(1, "One two, THREE four five six seven eight nine ten eleven twelve"), (2, None), (3, ""),
         (1, "One two, THREE four five six seven eight nine ten eleven twelve"),
         (4, "x  short   Äpfel y one"), (5, "short äpfel"), (None, "aa aa aa aa aa aa aa aa aa aa aa aa"),
         (6, "two three four five six seven eight nine ten elevens")]
ITEMS = [(10, "two three four five six seven eight nine ten eleven"), (9, "SHORT Äpfel!"), (8, None), (7, "..."),
         (6, "aa " * 11), (5, "two three four five six seven eight nine ten eleven twelve"), (None, "zzz")]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 40])
def test_decontamination_matches_brute_force(spark, docs_of, block, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(decontaminate.find, "__defaults__", (10, block))
    found = decontaminate.report(docs_of(CASES), items).collect()
    assert Counter(map(tuple, found)) == plain_contamination(CASES, ITEMS)


def test_decontamination_spans_and_columns(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(CASES).selectExpr("*", "1 as n_hit_", "2 as items")
    (row,) = decontaminate.find(docs.where("doc_id = 4"), items).collect()
    assert [row.text[s.start: s.end] for s in row.spans] == ["short   Äpfel"]
    assert sorted(decontaminate.clean(docs, items).columns) == sorted(docs.columns)
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {2, 3, 5, 6}  # only A-Z is lower-cased
    assert decontaminate.report(docs_of([]), items).count() == 0
    assert decontaminate.report(docs_of(CASES), items.limit(0)).where("contaminated").count() == 0


def test_decontamination_passes_repeated_items_once(spark, docs_of, monkeypatch):
    lists, build = [], decontaminate.automaton
    monkeypatch.setattr(decontaminate, "automaton", lambda items, n: lists.append(list(items)) or build(lists[-1], n))
    items = spark.createDataFrame(ITEMS + [ITEMS[0]] * 500, "item_id long, text string")
    found = decontaminate.report(docs_of(CASES), items).collect()
    assert Counter(map(tuple, found)) == plain_contamination(CASES, ITEMS)
    (passed,) = lists
    assert len(passed) == len(set(passed)) <= len(ITEMS)


# ---------------------------------------------------------------------- SimHash

def plain_print(text):
    w = plain_words(text)
    shingles = [" ".join(w[i: i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(rows):
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return Counter((d, f"{p:016x}", least.get(top(i))) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def test_simhash_query_on_documents(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert Counter(map(tuple, queries.op10_simhash(spark, sf_dir).collect())) == plain_groups(rows)


def test_simhash_edges(spark, docs_of):
    rows = [(5, "A b c d"), (3, "a B c d"), (None, "a b c d"), (9, None), (8, ""), (7, "one"), (2, "one two"), (5, "x y z"),
            (None, LONG), (6, "  ")]
    docs = docs_of(rows).selectExpr("*", "1 as fp", "2 as component_id")
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == plain_groups(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([3, 6, 7, 2, 5, None])
    assert simhash.near_duplicates(docs_of([])).count() == 0


def near_copies():
    """Texts with copies in which from none to many words are changed, in chains too."""
    rng = np.random.default_rng(12)
    rows = []
    for group in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, rng.integers(3, 300))]
        for _ in range(rng.integers(1, 6)):
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
            for at in rng.integers(0, len(words), rng.integers(0, 1 + len(words) // 25)):
                words[at] = f"v{rng.integers(0, 5000)}"
    return rows


def test_keep_one_matches_brute_force_jaccard(spark, docs_of):
    rows = near_copies()
    sets = []
    for _, text in rows:
        w = plain_words(text)
        sets.append({tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))})
    prints = [plain_print(t) for _, t in rows]
    group, far = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            close = (prints[i] ^ prints[j]).bit_count() <= 3
            alike = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            far += alike and not close
            if close or alike:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    assert far > 10  # pairs that the fingerprints alone do not link
    least = {}
    for g, (doc, _) in zip(group, rows):
        least[g] = min(doc, least.get(g, doc))
    assert sorted(r.doc_id for r in simhash.keep_one(docs_of(rows)).collect()) == sorted(least.values())


def test_jaccard_bucket_of_unlike_sets_makes_no_pair_rows(spark, monkeypatch):
    """A group whose members meet but are hardly linked: every link counts, no pair is a row."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 200)]
    texts = []
    for i in range(150):
        words = list(base)
        for at in rng.integers(0, 200, 12):
            words[at] = f"v{rng.integers(0, 10**6)}"
        texts.append(" ".join(words))
        if i % 3 == 0:  # a link far from the ends of the bucket, in chains of up to three
            for _ in range(rng.integers(1, 3)):
                words[rng.integers(0, 200)] = f"u{rng.integers(0, 10**6)}"
                texts.append(" ".join(words))
    sets = [set(jaccard.shingles(t.encode(), 5)) for t in texts]
    group = list(range(len(texts)))
    for i, s in enumerate(sets):
        for j in range(i):
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    wanted = {frozenset(i for i, g in enumerate(group) if g == x) for x in group}
    assert 50 < len(wanted) < 160

    rows = []
    stored = jaccard.stored

    def counted(df, name):
        out = stored(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    monkeypatch.setattr(jaccard, "TILE", 40, raising=False)
    frame = spark.createDataFrame([(i, [7, i], t) for i, t in enumerate(texts)],
                                  "set_id long, keys array<long>, text string")
    found = [tuple(r) for r in jaccard.links(frame.select("set_id", "keys"), frame.select("set_id", "text")).collect()]
    part = list(range(len(texts)))
    for u, v in found:
        assert len(sets[u] & sets[v]) >= 0.8 * len(sets[u] | sets[v])
        part = [part[u] if g == part[v] else g for g in part]
    assert {frozenset(i for i, g in enumerate(part) if g == x) for x in part} == wanted
    assert max(rows) <= 2 * len(texts) * (1 + len(texts) // 40)  # all pairs: some 20,000


def test_jaccard_counts_shared_hashes(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(30)]
    for block in (4096, 7):
        monkeypatch.setattr(jaccard, "_BLOCK", block)
        assert jaccard.common(sets[:12], sets[12:]).tolist() == [
            [len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert jaccard.common(sets[:2], [np.array([], np.uint64)]).tolist() == [[0], [0]]


def test_simhash_links_match_all_pairs(spark):
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    prints = {0, 2**64 - 1}
    for c in centres:
        for _ in range(30):
            x = int(c)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = {tuple(sorted(r)) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()}
    wanted = {tuple(sorted((a, b))) for a in signed for b in signed
              if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert found == wanted
