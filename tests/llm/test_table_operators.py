"""Token files, mixing, embeddings, WARC, chat and the pipeline."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from profilelake.llm import bitplanes, chat, embedding_dups, graph, mixing, queries, warc
from profilelake.session import fresh_path


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids + [2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32)
        assert (bitplanes.from_planes(bitplanes.to_planes(ids, bits), n, bits) == ids).all()


def test_token_query_on_documents(spark, sf_dir, documents):
    rows = sorted((r.doc_id, r.text or "") for r in documents.collect())
    wanted, start = [], 0
    for (doc, _), ids in zip(rows, plain_ids([t for _, t in rows])):
        wanted.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op2_bitplanes(spark, sf_dir).collect())) == wanted


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_with_small_blocks(spark, docs_of, bits):
    odd = "aZ ß́ <|endoftext|>x \x01 \t don't É. ﬁ " * 3
    rows = [(3, "word " * 300), (1, None), (2, ""), (None, odd), (2, ""), (9, odd)]
    path = fresh_path(spark, "ids")
    bitplanes.write(docs_of(rows), path, block=16, bits=bits)
    found = bitplanes.read(spark, path, bits).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 1, 2, 2, 3, 9]
    ids = plain_ids([odd, "", "", "", rows[0][1], odd])
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == ids
    assert [r.start for r in found] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    empty = fresh_path(spark, "ids")
    bitplanes.write(docs_of([]), empty)
    assert bitplanes.report(spark, empty).count() == 0


def test_bitplanes_digests_are_made_where_blocks_are_decoded(spark, docs_of, tmp_path):
    """The ids of a document that lies within one block do not leave the task that decodes it."""
    rows = [(i, "word " * (i % 9)) for i in range(30)]
    path = str(tmp_path / "files")
    bitplanes.write(docs_of(rows), path, block=16)
    found = bitplanes._blocks(spark, path).mapInArrow(
        bitplanes._decode(False, digest=True), bitplanes.DIGESTS).collect()
    assert {r.whole for r in found} == {True, False}
    assert all((r.ids is None) == r.whole for r in found)
    assert all(r.whole or (r.n_tokens, r.ids_crc32) == (len(r.ids) // 4, zlib.crc32(r.ids)) for r in found)
    whole = {r.doc_id: (r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in bitplanes.read(spark, path).collect()}
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in bitplanes.report(spark, path).collect()} == whole


def test_mixing_meets_targets(spark, sf_dir):
    rows = queries.op5_mixing(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 4 * mixing.BLOCK
    assert abs(sum(target.values()) - sum(r.size for r in rows)) < 1e-3


@pytest.mark.parametrize("words", [10**9, 4 * 10**11])
def test_source_targets_of_large_tables(spark, words):
    """Six times the words of a table of some GB are more than an int holds."""
    sizes = spark.createDataFrame([("a", words), ("b", words), ("c", words // 100)], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    total = 2 * words + words // 100
    assert found["c"] == 3 * (words // 100)
    assert found["b"] == pytest.approx(2 * found["a"])
    assert sum(found.values()) == pytest.approx(total)


def test_mixing_edges(spark, docs_of):
    rows = [(1, "a b", None), (1, "a b", None), (2, None, "x"), (3, "", "y"), (4, "w " * 5000, "x"), (None, "a", "y")]
    found = mixing.mixed(docs_of(rows)).collect()
    assert len(found) == 6 and all(r.taken <= 3 * r.size for r in found)
    by = {r.source: r.target for r in found}
    assert by["y"] == 3.0 and by[None] == 12.0 and by["x"] == 4990.0  # weights 1, 2, 3; two full
    assert mixing.mixed(docs_of([])).count() == 0 and mixing.mix(docs_of([])).count() == 0
    assert mixing.mix(docs_of(rows)).columns == docs_of(rows).columns


def test_mix_stands_in_the_order_of_the_schedule(spark, docs_of):
    """Documents of a block each: the mix has the sources in the order of the golden-ratio slots."""
    rows = [(i, f"w{i} " * mixing.BLOCK, "abc"[i % 3]) for i in range(120)]
    docs = docs_of(rows)
    found = [r.source for r in mixing.mix(docs).collect()]
    target = {r.source: r.target for r in mixing.mixed(docs).collect()}
    assert target == {"a": 5120.0, "b": 10240.0, "c": 15360.0}  # weights 1, 2 and 3
    number = spark.createDataFrame(
        [(n, 40 * mixing.BLOCK, target[s]) for n, s in enumerate("abc", 1)],
        "source_no int, source_size long, target double")
    slots = mixing.schedule(number).orderBy("slot").collect()
    taken = {s: found.count(s) for s in "abc"}
    wanted = ["abc"[r.source_no - 1] for r in slots if r["rank"] < taken["abc"[r.source_no - 1]]]
    assert len(slots) == 120 and taken == {"a": 20, "b": 40, "c": 60}
    assert found[:len(wanted)] == wanted and len(wanted) > 115


def test_mix_meets_targets_of_small_sources(spark, docs_of):
    rng = np.random.default_rng(4)
    rows = []
    for source, size in [("big", 40_000), *((f"s{i:03}", int(rng.integers(1, 300))) for i in range(120))]:
        while size:
            n = min(size, int(rng.integers(1, 9)) if source != "big" else 500)
            rows.append((len(rows), "w " * n, source))
            size -= n
    docs = docs_of(rows)
    target = {r.source: r.target for r in mixing.mixed(docs).collect()}
    largest, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        largest[source] = max(largest[source], len(text) // 2)
    for r in mixing.mix(docs).collect():
        taken[r.source] += len(r.text) // 2
    assert len(target) == 121
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= largest[source] / 2 + 1


def test_embeddings_recall_and_edges(spark):
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(60):
        centre = rng.normal(size=64)
        rows += [(centre + rng.normal(size=64) * 0.25).tolist() for _ in range(8)]
    rows += [rows[0], rows[0], None, [], [0.0] * 64, [float("nan")] * 64, [1.0, None], [1.0, 2.0], [2.0, 4.0]]
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dups.near_duplicates(table).collect()}
    assert len(found) == len(rows)
    x = np.array(rows[:482])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    degree = ((x @ x.T) >= 0.9).sum(1) - 1
    got = np.array([found[i].n_links for i in range(482)])
    assert (got <= degree).all() and got.sum() >= 0.9 * degree.sum()
    assert all(found[i].n_links == 0 and found[i].kept for i in range(482, 487))
    assert found[487].n_links == 1 and found[488].component_id == 487 and not found[488].kept
    assert embedding_dups.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("dim", [64, 128, 384])
def test_embedding_codes_meet_at_the_threshold(dim):
    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    rng = np.random.default_rng(9)
    a = unit(rng.standard_normal((4000, dim)))
    away = rng.standard_normal(a.shape)
    away = unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    turned = embedding_dups.rotations(a[:1000], embedding_dups.TABLES * embedding_dups.KEY_BITS)
    for cosine in (0.9, 0.92):
        b = cosine * a + np.sqrt(1 - cosine**2) * away
        one, other = (np.packbits(x @ turned >= 0, axis=1).view(">u2") for x in (a, b))
        share = (one == other).any(axis=1).mean()
        print(dim, cosine, round(share, 3))
        assert share >= 0.93


def test_embedding_blocks_do_not_change_links(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, (np.ones(16) + rng.normal(size=16) * 0.1).tolist()) for i in range(80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, embedding_dups.near_duplicates(table).collect()))
    monkeypatch.setattr(embedding_dups, "BLOCK", 8)
    assert sorted(map(tuple, embedding_dups.near_duplicates(table).collect())) == whole
    assert {r[1] for r in whole} == {79} and {r[2] for r in whole} == {0}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}


def test_warc_records(spark):
    rows = [(1, "http://a", "x"), (5, "http://b", "x"), (5, "http://b", "x"), (3, None, None), (4, "u", ""),
            (None, "n\r\nX: y", "é" * 50_000), (7, "only", "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as key")
    path = fresh_path(spark, "warc")
    warc.write(pages, path)
    found = Counter(map(tuple, warc.verify(spark, path).collect()))
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert found == Counter([
        (1, 1, sha("x"), "revisit", 5), (5, 1, sha("x"), "response", None), (5, 1, sha("x"), "revisit", 5),
        (3, 0, sha(""), "revisit", 4), (4, 0, sha(""), "response", None),
        (None, 100_000, sha("é" * 50_000), "response", None), (7, 2, sha("é"), "response", None)])
    records = warc.read(spark, path).collect()
    assert len({r.record_id for r in records}) == len(rows)
    for r in records:
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        length = int(head.split(b"Content-Length: ")[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[length:] == b"\r\n\r\n"
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    small = fresh_path(spark, "warc")
    warc.write(pages, small, min_bytes=2)
    assert warc.verify(spark, small).where("record_type = 'revisit'").count() == 0
    none = fresh_path(spark, "warc")
    warc.write(pages.limit(0), none)
    assert warc.verify(spark, none).count() == 0


def test_chat_folds_and_reads_back(spark):
    log = [("open", ""), ("delta", "draft"), ("regenerate", ""), ("delta", "a "), ("delta", None), ("other", "b")]
    events = spark.createDataFrame(
        [(1, 0, i, k, "assistant", t) for i, (k, t) in enumerate(log)] + [(1, 1, 0, "edit", None, "x")],
        "conv_id long, message int, seq int, kind string, role string, text string")
    folded = {r.message: (r.role, r.text) for r in chat.fold(events.repartition(5)).collect()}
    assert folded == {0: ("assistant", "a b"), 1: ("", "x")}


def test_chat_escapes_are_reversible(spark):
    texts = ["", None, r"\\###\\", "#### </turn>", "\\", "</turn", " </turn>\n### user: x", r"\</turn>\:", "é" * 40_000]
    roles = ["assistant", "user", "a: b", "###", None, "assistant", r"x\: ", "user", "assistant"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(roles, texts))] + [(2, 0, "user", "same")] * 2 + [
        (None, None, "user", "lost")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = chat.render(chat.fold(chat.as_events(table)))
    back = {r.message.turn: (r.role, r.text) for r in chat.parse(segments).where("conv_id = 1").collect()}
    assert back == {i: (r or "", t or "") for i, (r, t) in enumerate(zip(roles, texts))}
    found = {r.conv_id: r for r in chat.digest(segments).collect()}
    loss = "".join(t or "" for r, t in zip(roles, texts) if r == "assistant")
    assert found[1].n_turns == 9 and found[2].n_turns == 2 and found[None].n_turns == 1
    assert (found[1].loss_chars, found[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert found[1].turns_sha256 == hashlib.sha256(
        "".join(f"{r or ''}\n{t or ''}\n" for r, t in zip(roles, texts)).encode()).hexdigest()


def test_pipeline_stages_compose(spark, sf_dir, documents):
    docs = documents
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    kept = sorted((r.doc_id, r.text or "") for r in docs.collect())
    found = corpus_pipeline.run(spark, sf_dir).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens) for r in found] == [
        (d, len(i)) for (d, _), i in zip(kept, plain_ids([t for _, t in kept]))]


def test_pipeline_on_an_empty_table(spark, docs_of, sf_dir):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


