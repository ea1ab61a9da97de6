"""Packing against best fit decreasing one piece at a time, and against the plain tokenizer."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
DEFINITION = open(PATH, encoding="utf-8").read()


def one_by_one(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def rooms_of(steps, capacity):
    used = {}
    for s in steps:
        for j in range(s.pieces):
            where = s.sequence + j // s.each
            assert used.get(where, 0) == s.offset + (j % s.each) * s.length
            used[where] = used.get(where, 0) + s.length
    assert sorted(used) == list(range(len(used)))
    return sorted(capacity - x for x in used.values())


def test_steps_are_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.choice([1, 2, 10, 37, 64])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(120))]
        counts = {x: lengths.count(x) for x in set(lengths)}
        steps = packing.best_fit_decreasing(counts, capacity)
        for length, n in counts.items():
            nths = [k for s in steps if s.length == length for k in range(s.nth, s.nth + s.pieces)]
            assert nths == list(range(n))
        assert rooms_of(steps, capacity) == one_by_one(lengths, capacity)


def test_room_tree():
    rng = random.Random(2)
    tree, rooms = packing.RoomTree(100), set()
    for _ in range(2000):
        room = rng.randint(1, 100)
        (rooms.discard if room in rooms else rooms.add)(room)
        tree.set(room, room in rooms)
        least = rng.randint(1, 100)
        assert tree.tightest(least) == min((r for r in rooms if r >= least), default=None)


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_encoder_equals_tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    encoder = packing.Encoder(DEFINITION)
    texts = [
        "Hello, World... it's  FINE.\n\n\tDon't!",
        "a\x1cb\x85c d e \x1f f",
        "İstanbul Σίσυφος étude é, é, ﬁne 12,345.67 naïve. ... ., word.. x.y, 中文 文字。",
        "<|endoftext|> x<|startoftext|>y emoji 🤦🏼‍♂️. don't. 'll. I'm,",
        "",
        ".",
    ]
    texts += [None, texts[1], "  \n", texts[0]]
    for _ in range(2):
        assert encoded(encoder, texts) == [plain_ids(tokenizer, t) for t in texts]
        # A slice of a longer column.
        assert encoded(encoder, pa.array(["x", *texts, "y"]).slice(1, len(texts))) == [plain_ids(tokenizer, t) for t in texts]


def encoded(encoder, texts):
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    tokens = encoder.encode(texts, packing.END_ID)
    return [tokens.ids[a:b].tolist() for a, b in zip(tokens.bounds, tokens.bounds[1:])]


def test_blanks_are_those_of_the_tokenizer():
    """Every character between two letters: parted by Arrow if and only if it is white space."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    split = pc.utf8_split_whitespace(pa.array([f"a{c}b" for c in chars]))
    parted = {c for c, n in zip(chars, split.value_lengths().to_pylist(), strict=True) if n == 2}
    assert parted == {c for c in chars if c.isspace()}


def test_other_tokenizers_are_used_whole():
    definition = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    encoder, text = packing.Encoder(definition), "Hello  world, it's two  blanks.\n"
    plain = Tokenizer.from_str(definition).encode(text, add_special_tokens=False).ids
    assert encoded(encoder, [text, "", text]) == [[*plain, packing.END_ID], [packing.END_ID], [*plain, packing.END_ID]]


def test_known_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_PARTS", 30)
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.Encoder(DEFINITION)
    rng = random.Random(3)
    for _ in range(40):
        texts = [" ".join(f"w{chr(97 + rng.randrange(26))}{rng.choice(['x,', 'É.', 'yz', '9'])}" for _ in range(20))]
        assert encoded(encoder, texts) == [plain_ids(tokenizer, texts[0])]
    assert len(encoder.known) + len(encoder.older) < 400


def test_pack_table(spark, monkeypatch):
    rows = [(i, "word " * n) for i, n in enumerate([0, 1, 5, 9_000, 4_095, 4_096, 30, 30, 2_000, 2_095])]
    rows += [(7, rows[7][1]), (None, "null id"), (50, None), (51, "É " * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("offset", F.lit("x"))
    pieces = packing.pack(docs.repartition(3), DEFINITION, ids=True).collect()
    plain = packing.pack(docs.repartition(3), DEFINITION)
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    merged = packing.pack(docs.repartition(3), DEFINITION)
    assert "ids" not in plain.columns and sorted(map(tuple, plain.drop("sequence_id", "offset").collect()), key=repr) == sorted(
        (tuple(p[c] for c in plain.columns[:-2]) for p in pieces), key=repr
    )
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for doc, text in rows:
        ids = plain_ids(tokenizer, text)
        for k, start in enumerate(range(0, len(ids), 4096)):
            raw = np.array(ids[start : start + 4096], "<u4").tobytes()
            expected.append((doc, k, start, len(raw) // 4, raw, zlib.crc32(raw)))
    got = [(p["doc_id"], p["piece"], p["start"], p["length"], bytes(p["ids"]), p["ids_crc32"]) for p in pieces]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == len(one_by_one([x[3] for x in expected], 4096))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(docs, DEFINITION).count() == 0
