"""Fertility rules, packing and piece spans against plain versions and the libraries themselves."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventloom.llm import bin_slack, catalog, fertility, pieces

ODD = [None, "", " ", "\n\n", "a", "  a  b\n c\t\x00 ｱﬁ　é", "▁x ▁ y▁▁z", "<s> </s> <0x41> <|endoftext|>x <|startoftext|>",
       "é🎉 \u200b日本語テスト  x ", "İstanbul ΣΑΣ ÀéÅ x̌ y z's CAN'T", "# $ | <>\r\na b c a b c a b c", "x" * 30000, "a b " * 20000,
       "a\u00a0b\u2003c\x1cd\x85e", "THE. The, the; \"x\" a_b ñ. ß. ẞ Ñ!! ÿ Ÿ µ ª 12½"]


def made(seed, n):
    rnd, letters = random.Random(seed), "ab T\n\t é日🎉▁.1-<>'sßÀ"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*ODD, *made(2, 100), *made(2, 3)]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS KEPT", "7 AS ids", "8 AS start", "1 AS n_words")


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times, inside, seen, dup = collections.Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if times[w] > 1:
            inside |= {k, k + 1, k + 2}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), n < 50 or 100 * len(inside) > 50 * n)


def test_counts_equal_the_plain_version(spark, docs):
    out = fertility.quality_rules(docs, catalog.PIECE_MODEL)
    assert [c for c in out.columns if c == "KEPT"] == []
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text), r.text
        assert not (r.kept and r.base_failed)
        assert (r.chars_per_token is None) == (r.n_words == 0)
    assert fertility.quality_rules(docs.limit(0), catalog.PIECE_MODEL).count() == 0


def test_bands_reject_what_the_vocabulary_does_not_know():
    words = fertility.vocabulary(catalog.PIECE_MODEL)
    prose = ("When the river rose over its banks in early spring, farmers moved their cattle to higher ground and waited for word "
             "from town. Nobody could remember a year when so much snow had melted within one week; older people spoke about a flood "
             "that carried away both bridges, yet even they agreed this one seemed worse. By Thursday evening, volunteers had filled "
             "nearly nine hundred bags with sand, and school was closed until further notice.")
    greek = " ".join(["και", "το", "σπίτι", "είναι", "μεγάλο", "στην", "πόλη", "με", "πολλά", "δέντρα"] * 6 + [f"λέξη{k}" for k in range(40)])
    strange = " ".join(chr(0x12000 + k % 500) + chr(0x13000 + k % 300) for k in range(200))
    even = " ".join(["aaaa", "bbbb"] * 3 + [f"{'x' * (k % 7 + 1)}" for k in range(200)])
    verdict = {name: fertility.judge(t, words, fertility.BANDS, 50, 1000)[-1] for name, t in (("prose", prose), ("greek", greek), ("strange", strange), ("even", even))}
    assert verdict == {"prose": True, "greek": True, "strange": False, "even": False}
    assert fertility.script_of(greek) == "GREEK" and fertility.script_of("") == "LATIN"


def test_fill_is_the_closest_sum():
    rnd = random.Random(5)
    for _ in range(300):
        counts = {rnd.randint(1, 30): rnd.randint(1, 4) for _ in range(rnd.randint(0, 5))}
        room = rnd.randint(0, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        taken = bin_slack.fill(sorted(counts), counts.__getitem__, room)
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in taken.items())


def test_packing_covers_every_token_once_with_little_padding():
    rnd = random.Random(6)
    for lengths in ([], [1], [4096], [9000, 1, 1], [3000] * 7, [rnd.randint(1, 9000) for _ in range(400)]):
        sequences = bin_slack.pack(lengths)
        seen = [bytearray(n) for n in lengths]
        padding = 0
        for pieces_ in sequences:
            total = sum(n for _, _, n in pieces_)
            assert 0 < total <= 4096
            padding += 0 if total & (total - 1) == 0 else 4096 - total
            for doc, start, n in pieces_:
                assert n > 0 and not any(seen[doc][start:start + n])
                seen[doc][start:start + n] = b"\1" * n
        assert all(all(s) for s in seen)
        assert padding <= bin_slack.MAX_SLACK * len(sequences)


def test_pieces_hold_the_ids_of_the_tokenizer(spark, docs):
    model = Tokenizer.from_file(catalog.WORD_TOKENIZER)
    out = bin_slack.pieces(docs, catalog.WORD_TOKENIZER, buffer_tokens=3000).collect()
    want = collections.Counter((r.doc_id, tuple(model.encode(r.text or "", add_special_tokens=False).ids) + (2,)) for r in docs.collect())
    by_id = collections.defaultdict(list)
    for r in out:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_id[r.doc_id].append(r)
    for doc_id, rows in by_id.items():
        if doc_id is not None:
            rows.sort(key=lambda r: r.start)
            ids = tuple(np.frombuffer(b"".join(r.ids for r in rows), "<u4").tolist())
            assert want[doc_id, ids] == 1 and {r.doc_tokens for r in rows} == {len(ids)}
    assert sum(r.length for r in out) == sum(len(ids) * n for (_, ids), n in want.items())
    for _, rows in itertools.groupby(sorted(out, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
    assert bin_slack.pieces(docs.limit(0), catalog.WORD_TOKENIZER).count() == 0


def test_encoder_equals_the_tokenizer_word_by_word():
    model, own = Tokenizer.from_file(catalog.WORD_TOKENIZER), bin_slack.Encoder(catalog.WORD_TOKENIZER, 2)
    for text in [t or "" for t in ODD] + made(8, 1500):
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == [*model.encode(text, add_special_tokens=False).ids, 2], text


def test_ids_are_the_library_s_and_spans_tile_the_source(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=catalog.PIECE_MODEL)
    found = pieces.encode(docs, catalog.PIECE_MODEL)
    assert found.columns.count("ids") == 1
    for r in found.select("*", pieces.decoded("ids", catalog.PIECE_MODEL).alias("back")).collect():
        text = r.text or ""
        raw = text.encode()
        assert r.ids == model.encode(text) and r.back == model.decode(r.ids)
        assert r.begins[1:] == r.ends[:-1]
        assert not r.ids or (r.begins[0], r.ends[-1]) == (0, len(raw))
    assert pieces.encode(docs.limit(0), catalog.PIECE_MODEL).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_compiled_maps_are_read_as_the_library_reads_them(tmp_path, rule):
    with open(catalog.PIECE_MODEL, "rb") as file:
        model = pieces.proto.ModelProto.FromString(file.read())
    maps = pieces.proto.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    model.normalizer_spec.CopyFrom(maps.normalizer_spec)
    path = tmp_path / "mapped.model"
    path.write_bytes(model.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.Encoder(str(path))
    for text in [t or "" for t in ODD] + made(9, 800) + ["ﬁ ① Ⅳ ｶﾞ ㌔ Å e\u0301", "\u3000全角ＡＢＣ\u3000"]:
        ids, begins, ends = own.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert (begins <= ends).all() and (not len(ends) or ends[-1] <= len(text.encode()))
    ids, begins, ends = own.encode("x ① ﬁn")
    assert "x ① ﬁn".encode()[begins[-1]:ends[-1]].decode().endswith("n")


def test_bands_reject_low_quality_that_passes_the_counts():
    words, sf = fertility.vocabulary(catalog.PIECE_MODEL), "/root/testdata/sf0.1"
    labelled = pd.read_parquet(f"{sf}/documents.parquet", columns=["doc_id", "text"]).merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    rejected, passed = collections.Counter(), collections.Counter()
    for text, quality in zip(labelled["text"], labelled["quality"], strict=True):
        row = dict(zip(fertility.FIELDS, fertility.judge(text, words, fertility.BANDS, 50, 50), strict=True))
        if not row["base_failed"]:
            passed[quality] += 1
            rejected[quality] += not row["kept"]
    assert rejected[0] > 0.2 * passed[0] > 20 and rejected[1] < 0.005 * passed[1]
