"""Repair of conversations, phrase collocations and sentence pieces against brute force, SQL and the library."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import assert_same, connect

import __spark_entry__ as entry_point
from marketlake.llm import phrases, sentence_piece, turn_repair

# --- conversations ---------------------------------------------------------------------------


def cheapest_by_trial(codes):
    """All edits with up to two rows put in at each place."""
    good = re.compile(r"(s?(ua)+)?").fullmatch
    best = None

    def puts(roles, cost, audit):
        for n in range(3):
            for put in itertools.product("ua", repeat=n):
                yield roles + "".join(put), cost + 2 * n, audit + "I" * n

    def walk(at, roles, cost, audit):
        nonlocal best
        if best and cost > best[0]:
            return
        for roles, cost, audit in puts(roles, cost, audit):
            if at == len(codes):
                if good(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
                continue
            code = codes[at]
            walk(at + 1, roles, cost + 3, audit + "D")
            if code != "-":
                extra = int(code.isupper())
                if code.lower() in "sua":
                    walk(at + 1, roles + code.lower(), cost + extra, audit + "K")
                for role in "ua":
                    walk(at + 1, roles + role, cost + 2 + extra, audit + "R")

    walk(0, "", 0, "")
    return best


def test_parser_equals_trial_of_all_edits():
    rnd = random.Random(1)
    for n in range(5):
        for _ in range(25):
            codes = "".join(rnd.choices("suaxSUA-X", k=n))
            assert turn_repair.cheapest(turn_repair.parse(codes)) == cheapest_by_trial(codes), codes


def test_blocks_join_to_what_one_parse_gives():
    rnd, parser = random.Random(2), turn_repair._Parser()
    for _ in range(30):
        codes = "".join(rnd.choices("suaxSUA-X", k=rnd.randint(0, 40)))
        for code in codes:
            parser.add(code)
        assert turn_repair.cheapest(parser.cell()) == turn_repair.cheapest(turn_repair.parse(codes)), codes


TURNS = "conv_id long, turn long, role string, text string, place int, audit string, kind int"


def turn(conv, at, role, text):
    return (conv, at, role, text, 9, "x", 7)


def test_repaired_rows(spark):
    rows = [
        turn(1, 0, "system", "Be good."), turn(1, 1, "assistant", "Well."), turn(1, 3, "assistant", "cut of"),
        turn(2, 0, "user", " \n"), turn(3, None, None, None), turn(3, 5, "user", "A."), turn(3, 5, "user", "A."),
        turn(None, 1, "user", "Q?"), turn(None, 2, "assistant", "A!"),
    ]
    turns = spark.createDataFrame(rows, TURNS)
    found = {r.conv_id: r for r in turn_repair.repairs(turns).collect()}
    assert (found[1].gaps, found[1].truncated, found[1].illegal, found[1].cost, found[1].audit) == (1, 1, 2, 3, "KRK")
    assert (found[2].blank, found[2].cost, found[2].audit) == (1, 3, "D")
    assert (found[3].gaps, found[3].blank, found[3].duplicate, found[3].audit) == (0, 1, 1, "DKDI")
    assert (found[None].cost, found[None].audit) == (0, "KK")
    lines = sorted(((r.conv_id or 0, r.place, r.edit, r.role, r.text, r.turn) for r in turn_repair.repaired(turns).collect()), key=str)
    assert [r for r in lines if r[0] == 1] == [
        (1, 0, "K", "system", "Be good.", 0), (1, 1, "R", "user", "Well.", 1), (1, 2, "K", "assistant", "cut of", 3)
    ]
    assert [r[2:5] for r in lines if r[0] == 3] == [("K", "user", "A."), ("I", "assistant", "")]
    assert turn_repair.repairs(turns.limit(0)).count() == 0


def test_a_long_conversation_is_dealt_out(spark):
    """One conversation with all rows, over many partitions: as one parse of all its codes."""
    rnd = random.Random(3)
    roles = rnd.choices(["user", "assistant", "system", "tool"], k=600)
    texts = [rnd.choice([f"text {n}.", f"open {n}", " "]) for n in range(600)]
    turns = spark.createDataFrame([turn(7, n, r, t) for n, (r, t) in enumerate(zip(roles, texts))], TURNS).repartition(8)
    codes = []
    for role, text in zip(roles, texts):
        code = role[0] if role[0] in "sua" else "x"
        codes.append("-" if text == " " else code if text.endswith(".") else code.upper())
    parser = turn_repair._Parser()
    for code in codes:
        parser.add(code)
    row = turn_repair.repairs(turns).collect()
    assert [(r.cost, r.audit) for r in row] == [turn_repair.cheapest(parser.cell())]


def test_conversations_without_rows_keep_their_id(spark):
    import zlib

    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    rows = turn_repair.damaged_and_repaired(spark.createDataFrame([turn(gone, 0, "user", "Q?")], TURNS)).collect()
    assert [(r.conv_id, r.cost, r.audit, r.gaps) for r in rows] == [(gone, 0, "", 0)]


# --- phrases ---------------------------------------------------------------------------------


def phrases_by_count(docs, least, top=phrases.TOP):
    lower = {n: n + 32 for n in range(65, 91)}
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        longer = Counter()
        for p, a in frequent.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], a)
        rows = []
        for p, a in frequent.items():
            score, _, left, right = min((2000000 * a // (found[p[:k]] + found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
            if 100 * longer[p] < 80 * a:
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


DOCS = "doc_id long, text string, lang string, phrase string, word string, name long, f long, n long"


def test_collocations_equal_counts(spark):
    rnd = random.Random(4)
    vocabulary = ["The", "of", "é", "ÉA", "x", "new", "York", "😀", "city"]
    rows = []
    for n in range(400):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40))]
        text = "".join(w + rnd.choice([" ", "  ", "\t", " ", ", ", "\n", ".", "\x0b"]) for w in words)
        rows.append((n % 390, text, rnd.choice(["en", "und", None, ""]), "p", "w", 1, 2, 3))
    rows += [(1, None, "en", None, None, None, None, None), (None, "", None, None, None, None, None, None), (2, "a b " * 5000, "zz", "", "", 0, 0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    for least in (3, 30):
        got = sorted(map(tuple, phrases.collocations(docs.repartition(5), least=least).collect()))
        assert got == phrases_by_count([(r[2], r[1]) for r in rows], least)
    assert sorted(map(tuple, phrases.collocations(docs, least=3, top=4).collect())) == phrases_by_count([(r[2], r[1]) for r in rows], 3, 4)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_heavy_words_and_pairs_are_dealt_out(spark, monkeypatch):
    """A pair with nearly all words: its suffixes go to several tasks and are added up."""
    rnd = random.Random(5)
    rows = [(n, " ".join(f"hot pair w{rnd.randint(0, 30)}" for _ in range(60)), "en", "", "", 0, 0, 0) for n in range(200)]
    dealt = []
    whole = phrases._suffixes
    monkeypatch.setattr(phrases, "_suffixes", lambda *a: dealt.append(a[-3:-1]) or whole(*a))
    got = sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, DOCS)).collect()))
    assert got == phrases_by_count([(r[2], r[1]) for r in rows], 30)
    assert all(heavy and max(heavy.values()) > 1 for heavy in dealt[0])


def test_quicksort_counts():
    rnd = np.random.default_rng(6)
    read = rnd.integers(1, 6, size=(3000, 4)).astype(np.uint64)
    for n in range(1, 4):
        read[rnd.random(3000) < 0.2, n:] = 0
    times = rnd.integers(1, 4, size=3000)
    want = Counter()
    for row, t in zip(read.tolist(), times.tolist()):
        for n in range(2, 5):
            if all(row[:n]):
                want[tuple(row[:n])] += t
    for least in (1, 20):
        got = {}
        for depth, at, counts in phrases.quicksort(read, times, least):
            for i, c in zip(at, counts.tolist()):
                key = tuple(read[i, :depth].tolist())
                assert key not in got
                got[key] = c
        assert got == {p: c for p, c in want.items() if c >= least}


# --- sentence pieces -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


ODD = ["", " ", "  Hello  world\n\t ﬁ 　x  ▁a▁ ", "▁", "▁▁ a", "é😀 \x0b ok", "a\nb\n\n c", "x" * 5000, " " * 300, "漢字 かな😀😀", "<s> </s> <0x0A> <unk>", "\x00a", "ab" * 200 + " c"]


def test_pieces_spans_and_texts_equal_the_library(model):
    import sentencepiece

    library, ours = sentencepiece.SentencePieceProcessor(model_file=model), sentence_piece.SentencePieces(model)
    rnd = random.Random(7)
    texts = ODD + ["".join(rnd.choices("ab the in▁ \n\té😀漢0123.,ing", k=rnd.randint(0, 150))) for _ in range(400)]
    for text, (raw, ends) in zip(texts, ours.encode_all(texts)):
        want = library.encode(text, return_type="proto") if text else None
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == library.encode(text)
        if text:
            assert ends.tolist() == [p.end for p in want.pieces]
        assert ours.decode([1, *ids, 2]) == library.decode([1, *ids, 2])
    for _ in range(500):
        ids = [rnd.choice([rnd.randrange(300), rnd.randrange(32000), 259]) for _ in range(rnd.randint(0, 8))]
        assert ours.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("prefix,remove,escape", [(1, 1, 1), (1, 0, 1), (0, 1, 1), (0, 0, 0), (1, 1, 0)])
def test_compiled_map_equals_the_library(prefix, remove, escape):
    import sentencepiece

    options = {"add_dummy_prefix": bool(prefix), "remove_extra_whitespaces": bool(remove), "escape_whitespaces": bool(escape)}
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", **options)
    spec = dict(sentence_piece._fields(next(raw for n, raw in sentence_piece._fields(library.serialized_model_proto()) if n == 3)))
    ours = sentence_piece.Normaliser(spec[2], sentence_piece.Settings(bool(prefix), bool(remove), bool(escape)))
    rnd = random.Random(8)
    for _ in range(500):
        text = "".join(rnd.choices("ab  ▁\n\té😀漢ﬁﬀ①Ⅳ　​㌔カ゛é½Å", k=rnd.randint(0, 14)))
        want, places = library.normalize(text, with_offsets=True)
        got = ours.traced(text)
        assert got.text == want
        assert [len(text.encode()[:b].decode()) for b in got.source] == list(places)


def test_round_trip_of_odd_rows(spark, model):
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = [(n, t, [1], "e") for n, t in enumerate([*ODD, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, ends string")
    for r in sentence_piece.round_trip(docs, model).collect():
        ids = library.encode(rows[r.doc_id][1] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    encoded = sentence_piece.encode_documents(docs, model)
    for r in encoded.collect():
        text = (rows[r.doc_id][1] or "").encode()
        assert b"".join(text[b:e] for b, e in zip(r.begins, r.ends)) == text
        assert len(r.ids) == len(r.begins) == len(r.ends)
    texts = {r.doc_id: r.text for r in sentence_piece.decode_documents(encoded, model).collect()}
    assert texts[6] == ODD[6] and texts[13] == ""


def test_op13_reads_the_whole_table_as_the_library(spark, model, sf_dir):
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = entry_point.queries()["op13_sentence_piece_round_trip"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("key", ["op11_conversation_repair", "op12_phrase_collocations"])
def test_sql(spark, sf_dir, key):
    assert assert_same(entry_point.queries()[key](spark, sf_dir), connect(sf_dir), entry_point.oracle_sql()[key]) > 0
