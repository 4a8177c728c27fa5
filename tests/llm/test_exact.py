"""Operators against brute force, libraries, or the SQL counterpart."""

import base64
import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from marketlake.llm import bpe, fingerprint, html_template, jaccard_join, lm_trie, personal_data, queries, reply_trees, token_count, toxicity
from marketlake.llm.components import components
from marketlake.llm.elias_fano import EliasFano
from marketlake.llm.merge_automaton import MergeAutomaton
from marketlake.llm.packed import pack, pack_sorted, unpack, unpack_sorted

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def texts(spark, smallest_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest_dir}/documents.parquet").select("doc_id", "text").collect()}


def shingles(text, n, lower=False):
    w = SPACE.findall(text.translate(LOWER) if lower else text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_sql(spark, smallest_dir, key):
    assert_same(queries.QUERIES[key](spark, smallest_dir), connect(smallest_dir), queries.ORACLE[key])


# --- op1 -----------------------------------------------------------------------------------


def test_fingerprints(spark, smallest_dir, texts):
    got = {r["doc_id"]: r for r in queries.op1_document_fingerprints(spark, smallest_dir).collect()}
    ids = sorted(texts)
    errors = []
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, after = texts[i], texts[following]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row = got[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [abs(row["near_edited"] - jaccard(shingles(text, 5), shingles(edited, 5)))]
        errors += [abs(row["near_next"] - jaccard(shingles(text, 5), shingles(after, 5)))]
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.03


def test_merged_fingerprints_are_those_of_the_whole(spark):
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 1 << 48, 400, dtype=np.uint64) for _ in range(6)]
    rows = [(n % 2, fingerprint.pack(np.unique(p)[: fingerprint.K])) for n, p in enumerate(parts)] + [(5, "")]
    merged = fingerprint.merge(spark.createDataFrame(rows, "g int, fingerprint string"), "g")
    got = {r["g"]: r["fingerprint"] for r in merged.collect()}
    for g in (0, 1):
        assert got[g] == fingerprint.pack(np.unique(np.concatenate(parts[g::2]))[: fingerprint.K])
    assert got[5] == "" and len(base64.b64decode(got[0])) == 6 * fingerprint.K
    a, b = np.arange(1000, dtype=np.uint64) << np.uint64(30), np.arange(500, dtype=np.uint64) << np.uint64(30)
    assert fingerprint.covered(b[:128], a[:128]) == 1.0 and fingerprint.distinct(b[:100]) == 100


# --- op2 -----------------------------------------------------------------------------------


def test_elias_fano():
    rng = np.random.default_rng(1)
    for top in (1, 5, 1000, 1 << 40):
        for n in (0, 1, 2, 63, 64, 65, 500):
            values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
            coded = EliasFano.encode(values)
            assert (coded.values() == values).all()
            assert [coded.access(i) for i in range(n)] == values.tolist()
            for wanted in (0, top // 2, top):
                assert coded.successor(wanted) == np.searchsorted(values, wanted)
    assert (unpack_sorted(pack_sorted(np.array([3, 3, 900], dtype=np.uint64))) == [3, 3, 900]).all() and len(unpack(pack(np.zeros(0)))) == 0


@pytest.mark.parametrize("block_bytes", [1 << 23, 1 << 14])
def test_language_model(spark, smallest_dir, texts, block_bytes):
    docs = spark.read.parquet(f"{smallest_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in lm_trie.score_documents(docs, block_bytes, 1 << 15).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    lines = {i: ["<", "<", *SPACE.findall(t.translate(LOWER)), ">"] for i, t in texts.items()}
    count = [collections.Counter() for _ in range(4)]
    context = [collections.Counter() for _ in range(4)]
    for i, line in lines.items():
        for at in range(2, len(line)):
            for n in (1, 2, 3):
                if not held[i]:
                    count[n][tuple(line[at - n + 1 : at + 1])] += 1
                    context[n][tuple(line[at - n + 1 : at])] += 1
    total, kinds = sum(count[1].values()), len(count[1])
    for i, line in lines.items():
        base = score = 0.0
        for at in range(2, len(line)):
            p = (count[1][(line[at],)] + 1) / (total + kinds + 1)
            base += math.log10(p)
            for n in (2, 3):
                p = (count[n][tuple(line[at - n + 1 : at + 1])] + lm_trie.MU[n] * p) / (context[n][tuple(line[at - n + 1 : at])] + lm_trie.MU[n])
            score += math.log10(p)
        row = got[i]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held[i], len(line) - 2, total)
        assert row["n_known"] == sum(count[1][(w,)] > 0 for w in line[2:])
        assert math.isclose(row["base_score"], base, rel_tol=1e-9) and abs(row["score"] - score) <= 0.002 * len(line)


# --- op3 -----------------------------------------------------------------------------------


def brute_components(sets, share):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize(("width", "share", "seed", "group"), [(4, 85, 1, 2000), (5, 80, 2, 3), (1, 85, 3, 4)])
def test_jaccard_join(spark, monkeypatch, width, share, seed, group):
    """Near copies of few originals, chains of them, one large group of copies and one shared passage."""
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    monkeypatch.setattr(jaccard_join, "SPLIT_CLASS", 8 if group > 4 else 1)
    random.seed(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = random.choices(words, k=30)
    docs = {}
    for group in range(25):
        text = random.choices(words, k=random.choice([3, 12, 40, 90]))
        for _ in range(random.randint(1, 9)):
            text = list(text)
            for _ in range(random.randint(0, 2)):
                text[random.randrange(len(text))] = random.choice(words)
            docs[len(docs)] = " ".join(text + (passage if group % 3 == 0 else []))
    for _ in range(60):
        docs[len(docs)] = docs[0]
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    sets = {i: shingles(t, width, lower=True) for i, t in docs.items()}
    expected = brute_components(sets, share)
    got = jaccard_join.linked(frame, width, share).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    kept = {r["doc_id"] for r in jaccard_join.one_of_each(frame, width, share).collect()}
    assert kept == set(expected.values())


@pytest.mark.parametrize(("width", "share", "group"), [(4, 85, 2000), (2, 80, 4), (1, 100, 3)])
def test_number_of_links(spark, monkeypatch, width, share, group):
    """Every link between rows counts once, also within components and in groups of several blocks."""
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    random.seed(width)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for size in [3, 20, 40, 41, 80] * 5:
        text = random.choices(words, k=size)
        for n in range(12):
            docs.append(" ".join(text))
            if n % 3:
                text = [*text[: n % 5], random.choice(words), *text[n % 5 + 1 :]][: size - n % 2]
    docs += ["", docs[30]]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    sets = [shingles(t, width, lower=True) for t in docs]
    near = lambda a, b: bool(a) and 100 * len(a & b) >= share * len(a | b)
    expected = {i: sum(near(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}
    assert {r["doc_id"]: r["n_links"] for r in jaccard_join.linked(frame, width, share).collect()} == expected


def test_sketches_lose_no_link():
    """Linked sets of any sizes, whose sketches may differ in width, stay; sets that share a half go."""
    rng = np.random.default_rng(5)
    for share in (50, 80, 85, 100):
        sets = []
        for size in [1, 2, 5, 60, 98, 100, 101, 110, 400, 3000]:
            whole = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            for gone in (0, 0.04, 0.08, 0.15, 0.3, 0.6):
                left = whole[: size - int(gone * size)]
                sets += [left, np.concatenate([left, rng.integers(0, 1 << 63, int(gone * size / 2), dtype=np.uint64)])]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        got = jaccard_join._alike([np.frombuffer(jaccard_join.sketch(s, share), dtype=np.uint8) for s in sets], sizes, share)
        both = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
        near = 100 * both >= share * (sizes[:, None] + sizes - both)
        assert not (near & ~got).any()
        unlike = (sizes[:, None] >= 60) & (sizes >= 60) & (both <= 0.3 * np.minimum(sizes[:, None], sizes))
        assert (got & unlike).sum() <= 0.02 * unlike.sum()


def test_texts_move_only_where_links_may_be(spark, monkeypatch):
    """Documents that share a long passage, but are unlike, are told apart before their sets are shuffled."""
    monkeypatch.setattr(jaccard_join, "token_classes", lambda *a: np.zeros(jaccard_join.CELLS, dtype=np.uint8))
    contents, moved = jaccard_join._contents, []

    def noted(texts, wanted, width):
        moved.append(wanted.count())
        return contents(texts, wanted, width)

    monkeypatch.setattr(jaccard_join, "_contents", noted)
    random.seed(9)
    words = [f"w{i}" for i in range(5000)]
    docs = []
    for _ in range(20):
        passage = random.choices(words, k=100)
        docs += [" ".join(passage + random.choices(words, k=100)) for _ in range(2)]
    docs += [docs[0] + " and", docs[7] + " so on"]
    got = jaccard_join.linked(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_links"] for r in got if r["n_links"]} == {0: 1, 40: 1, 7: 1, 41: 1}
    assert moved == [4]


def test_blocks_use_little_memory():
    """1,500 sets of one block: their overlaps are judged in strips, not as several matrices of doubles."""
    rng = np.random.default_rng(3)
    core = rng.integers(0, 1 << 40, 600, dtype=np.uint64)
    sets = [np.unique(np.concatenate([core[i % 50 :], rng.integers(0, 1 << 40, 20, dtype=np.uint64)])) for i in range(1500)]
    rows = [{"centre": 0, "low": 0, "high": 0, "side": 0, "set": i, "copies": 1, "centres": [0], "content": jaccard_join.pack_sorted(s)} for i, s in enumerate(sets)]
    table = pa.Table.from_pylist(rows)
    work = jaccard_join._block(85)
    tracemalloc.start()
    found = work(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    both = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets[:20]])
    sizes = np.array([len(s) for s in sets])
    near = 100 * both >= 85 * (sizes[:20, None] + sizes - both)
    counted = {r["a"]: r["n"] for r in found.to_pylist() if r["a"] == r["b"]}
    assert [counted.get(i, 0) for i in range(20)] == [int(row.sum()) - 1 for row in near]
    assert peak < 50e6


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in [*range(41), 100]) and got[201] == 200


# --- op5 -----------------------------------------------------------------------------------


def test_pages(spark, smallest_dir):
    import html

    pages = spark.read.parquet(f"{smallest_dir}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in html_template.extract(pages).collect():
        inner = re.search("<article>(.*)</article>", source[row["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert row["text"] == "\n\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


def test_template_without_article(spark):
    """The frame's constant notice, its menu, comments and a form are left out; slots keep their order."""
    def page(n):
        return (
            f"<html><head><title>t{n}</title></head><body><div class='menu'><a href=a>Home</a><a href=b>News {n}</a></div>"
            f"<div class=notice>We use cookies</div><div class=story><h2>Head {n}</h2><p>First {n} &lt;x&gt;<p>Second <a href=c>link</a> {n} and more text</div>"
            f"<div><p>All rights</p></div><form><p>Name {n}</p></form><section class='comments'><p>Reader {n}</p></section><script>var a='<p>no</p>'</script></body></html>"
        )

    rows = [(n, f"https://x.example/{n}", page(n)) for n in range(30)]
    got = {r["page_id"]: r["text"] for r in html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[7] == "Head 7\n\nFirst 7 <x>\n\nSecond link 7 and more text"


def test_copied_pages(spark):
    """Copies of a page, and one article on pages that differ around it, are extracted as one page is."""
    article = "<article><h1>Head</h1><p>Some text</p></article>"
    rows = [(n, "https://same.example/", f"<html><body>{article}</body></html>") for n in range(20)]
    rows += [(100 + n, f"https://near.example/{n}", f"<html><body><div>Visit {n}</div>{article}</body></html>") for n in range(20)]
    rows += [(200 + n, f"https://plain.example/{n}", f"<html><head><title>{n}</title></head><body><div><p>Head<p>Some text</div></body></html>") for n in range(20)]
    got = html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 60 and {r["text"] for r in got} == {"Head\n\nSome text"}


# --- op6 -----------------------------------------------------------------------------------


def test_fixed_patterns():
    text = "mail a.b+c@x-y.example.org, 1.2.3.4 300.1.1.1, 4111 1111 1111 1111 x +1 (555) 010-9999 y +12 z 1.2.3.4.5 4111111111111112"
    assert [text[s:e] for k, s, e in personal_data.base_spans(text)] == [
        "a.b+c@x-y.example.org", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999", "1.2.3.4",
    ]


def test_contexts_find_unseen_identifiers(spark):
    seeds = [(i, f"Please call Bob. His phone number: +1 ({200 + i}) 555-01{i:02} thanks") for i in range(9)]
    unseen = [(50, "Please call Eve. His phone number: 555.0199.77 thanks"), (51, "My order 555.0199.78 came"), (52, "version 10.20.30 is out")]
    docs = spark.createDataFrame(seeds + unseen, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in personal_data.span_digests(docs).collect()}
    assert got[50] == "phone:35:46" and got[51] == got[52] == "" and got[0].startswith("phone:")
    out = {r["doc_id"]: r["text"] for r in personal_data.redact(docs).collect()}
    assert out[50] == "Please call Eve. His phone number: [PHONE] thanks" and out[51] == unseen[1][1]


def test_personal_data_of_a_task_uses_little_memory():
    """Texts become strings some at a time, beside a batch of 40 MB."""
    n = 8_000
    texts = pa.array([f"mail a{i}@b.example " + "x" * 5_000 for i in range(n)])
    spans = pa.nulls(n, pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32(), "kind": pa.string()})))
    scan = lambda b: personal_data.scanned_batches(b)
    redact = lambda b: personal_data.redacted_batches(b, 1)
    for made, columns, names in ((scan, [texts], ["text"]), (redact, [texts, spans], ["text", "added"])):
        batch = pa.RecordBatch.from_arrays([pa.array(range(n)), *columns], names=["doc_id", *names])
        before = pa.total_allocated_bytes()
        tracemalloc.start()
        rows = held = 0
        for out in made(iter([batch])):
            rows += out.num_rows
            held = max(held, pa.total_allocated_bytes() - before)
        out = None
        left, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert rows == n and left < 1e6 and peak < 8e6 and held < 16e6, (left, peak, held)


# --- op7 and op8 ---------------------------------------------------------------------------


def odd_texts():
    random.seed(4)
    parts = [*"abcdehinorst  \n\t.0123éß€日😀'", "<s>", "</s>", "<0x0A>", "<|endoftext|>", "  ", "    ", "the ", "ing", "'s", "▁", "▁▁", "\r\n", "\x85", "　", "½"]
    return ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(2000)]


def test_token_counts(texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), token_count.counter(path)
    for text in [*odd_texts(), *texts.values()]:
        assert {own.tokens(text, size) for size in (7, 64, 1 << 16)} == {len(library.encode(text))}, text


def test_bpe(texts):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    library, own = tokenizers.Tokenizer.from_file(path), bpe.tokenizer(path)
    own.prepare(list(texts.values())[::2])
    for text in [*odd_texts(), *texts.values()]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_encoded_documents_decode(spark, texts):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    back = bpe.decode_documents(bpe.encode_documents(docs, path), path)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == texts


def test_workers_forget_the_words_of_an_encoded_task(spark):
    """Python workers go on to other stages: what one keeps of a task would count as memory of theirs."""
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    docs = spark.range(2_000, numPartitions=2).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 20), k -> sha1(string(id * 21 + k)))) AS text")
    assert bpe.encode_documents(docs, path).where("size(ids) > 21").count() == 2_000

    def kept(batches):
        own = bpe.tokenizer(path)
        n = sum(len(s) + len(s.old) for s in (own.words, own.spaced, own.bare)) + len(own.automaton._arcs)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, type=pa.int64())], names=["n"])

    assert spark.range(64, numPartitions=16).mapInArrow(kept, "n long").agg({"n": "max"}).first()[0] == 0


def test_encoding_a_task_uses_little_memory():
    """12,000 texts of words that never come again: groups of texts are small, and so is what is remembered."""
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    texts = [" ".join(f"{i:x}q{k}" for k in range(20)) for i in range(12_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    rows = sum(out.num_rows for out in bpe.encoded_batches(iter([batch]), path, "text", ["doc_id"]))
    left, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == len(texts) and left < 1e6 and peak < 80e6, (left, peak)


def test_hashing_keeps_nothing_after_a_task():
    from marketlake.llm import words

    column = words.filled(pa.array(["One two three four five"]))
    first = [s.tolist() for s in words.shingle_sets(column, 4)]
    words.forget()
    assert words._Powers.up.nbytes + words._Powers.down.nbytes == 16
    assert [s.tolist() for s in words.shingle_sets(column, 4)] == first


def test_new_parts_are_split_once_and_remembered():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    own, asked = bpe.ByteBpe(path), []
    plain = own.split
    own.split = lambda text: asked.append(text) or plain(text)
    groups = [[" ".join(["start", *(f"é{i}" for i in range(n, n + 900))])] for n in range(0, 2700, 300)]
    for texts in groups:
        own.prepare(texts, 2_000, 1_000)
        assert own.decode(own.encode(texts[0])) == texts[0]
    lead = [text for text in asked if text.startswith(" ")]
    assert len(lead) == len(set(lead)) == 3_300


def test_split_by_letters_is_the_pattern():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    own = bpe.tokenizer(path)
    ends = ["", *map(chr, range(0x21, 0x7F)), "..", "é", "'s"]
    for part in [a + b for a in ("", "word", "it's", "é", "a1", "_", "I'", "'") for b in ends]:
        assert list(own._behind_space(part)) == own.split(" " + part), part


def test_automaton_against_plain_merging():
    random.seed(8)
    for _ in range(60):
        symbols = "abc"
        pieces, merges = list(symbols), []
        while len(merges) < 12:
            a, b = random.choice(pieces), random.choice(pieces)
            if a + b not in pieces and len(a + b) < 8:
                merges.append((a, b))
                pieces.append(a + b)
        ranks = {m: n for n, m in enumerate(merges)}
        automaton = MergeAutomaton(symbols, merges, lambda a, b: ranks.get((a, b)), max_states=20)
        words = ["".join(random.choices(symbols + "?", (5, 5, 5, 1), k=random.randint(0, 14))) for _ in range(60)]
        for word in words:
            plain = list(word)
            while True:
                found = [(ranks[p], i) for i, p in enumerate(zip(plain, plain[1:])) if p in ranks]
                if not found:
                    break
                i = min(found)[1]
                plain[i : i + 2] = [plain[i] + plain[i + 1]]
            assert automaton.pieces(word) == plain and automaton.count(word) == len(plain)
        counts = {}
        automaton.read_sorted(sorted(words), lambda word, lasts, n: counts.update({word: n[-1]}))
        assert counts == {w: len(automaton.pieces(w)) for w in words}


# --- op9 -----------------------------------------------------------------------------------


def test_restoration(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    restorer = toxicity.Restorer(toxicity.letter_model(toxicity.letter_counts(docs)))
    disguised = {"1d10t": "idiot", "idiooot": "idiot", "tr@sh": "trash", "$cum": "scum", "m0r0n": "moron", "s.c.u.m": "scum", "cl0wn": "clown"}
    assert {w: restorer.restore(w) for w in disguised} == disguised
    assert restorer.words("the i d i o t. Ended,") == {"the", "i", "d", "o", "t", "idiot", "ended"}


def test_restoration_of_several_words_and_long_tokens(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    restorer = toxicity.Restorer(toxicity.letter_model(toxicity.letter_counts(docs)))
    assert {"you", "are", "a", "moron"} <= restorer.words("you are a m o r o n")
    assert {"idiot", "moron"} <= restorer.words("an i d i o t m o r o n.")
    assert "idiot" in restorer.words("x y z " * 13 + "i d i o t")
    assert restorer.restore("idi" + "o" * 56 + "t") == "idiot"
    assert {"moron", "idiot", "trash", "clown"} <= restorer.words("you.moron.go.away.you.idiot.and.take.your.trash.with.you.clown")
    assert "moron" in restorer.words("m" + ".m" * 40 + ".o.r.o.n")
    assert restorer.restore("x" * 100_000) == "x"


def test_held_out_accuracy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).join(labels, "doc_id").collect()
    for row in scored:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) and 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.5)
    held = [r for r in scored if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.95


# --- op10 ----------------------------------------------------------------------------------


def test_reply_tree(spark):
    odd = "a\\n<s>\\<\\|[/INST]\\\\[INST]<<SYS>>\n<|x|>"
    rows = [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", odd, 1.0), (1, 3, 1, "assistant", "b", 3.0), (1, 4, 2, "user\n<s>", "c", 9.0),
        (1, 5, 4, "assistant", "d", None), (2, 1, 9, "user", "orphan", 0.0), (3, 1, 2, "user", "x", 0.0), (3, 2, 1, "user", "y", 0.0), (1, None, 1, "user", "z", 0.0),
    ]
    tree = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")
    found = reply_trees.branches(tree).orderBy("tree", "rank", "place").collect()
    assert [(r["tree"], r["rank"], r["leaf"], r["id"]) for r in found] == [
        (1, 1, 5, 1), (1, 1, 5, 2), (1, 1, 5, 4), (1, 1, 5, 5), (1, 2, 3, 1), (1, 2, 3, 3), (2, 1, 1, 1),
    ]
    formatted = reply_trees.format_branches(tree, keep=1).where("tree = 1")
    row = formatted.select("formatted", reply_trees.read_turns(F.col("formatted")).alias("turns"), reply_trees.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).first()
    assert [(t["role"], t["text"]) for t in row["turns"]] == [("user", "root"), ("assistant", odd), ("user\n<s>", "c"), ("assistant", "d")]
    assert row["loss"] == odd + "d" and row["formatted"].count("<s>") == 4 and "[INST]" not in row["formatted"]


def test_long_chain(spark):
    rows = [(1, n, f"t{n}") for n in range(300)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, text string").selectExpr("conv_id", "turn", "if(turn % 2 = 1, 'assistant', 'user') as role", "text")
    row = reply_trees.conversation_digests(turns).first()
    assert row["n_turns"] == 300
    assert row["loss_sha256"] == hashlib.sha256("".join(f"t{n}" for n in range(1, 300, 2)).encode()).hexdigest()
