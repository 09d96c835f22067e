"""Encoding with offsets against the sentencepiece library, over models with character maps and other rules."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from casebook.llm import pieces, queries
from casebook.llm.common import table

MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
SIGNS = "ab cd  ▁▂\n\t\0éß語🎉ﬁ½Å̀​   WORLD the <s> <x>"


def compiled(rules):
    """A character map with the given replacements, laid out as the library reads it."""
    texts, at = b"", {}
    for new in rules.values():
        at.setdefault(new, len(texts))
        texts += new + b"\0"
    units, taken, bases = {0: 0}, {0}, set()
    todo = [(0, b"")]
    while todo:
        place, prefix = todo.pop()
        labels = sorted({key[len(prefix)] for key in rules if key.startswith(prefix) and len(key) > len(prefix)})
        ends = prefix in rules
        wanted = labels + [0] * ends
        base = next(b for b in itertools.count(1) if b not in bases and not any(b ^ x in taken for x in wanted))
        bases.add(base)
        units[place] = units.get(place, 0) | (place ^ base) << 10 | ends << 8
        taken.update(base ^ x for x in wanted)
        if ends:
            units[base] = 0x80000000 | at[rules[prefix]]
        for x in labels:
            units[base ^ x] = x
            todo.append((base ^ x, prefix + bytes([x])))
    size = (max(units) // 256 + 1) * 256
    blob = np.array([units.get(i, 0x80000000) for i in range(size)], "<u4").tobytes()
    return len(blob).to_bytes(4, "little") + blob + texts


RULES = {
    "ﬁ": "fi", "½": "1/2", "Å": "Å", "A": "a", "ab": "X Y", "abc": "z", " ": " ", "​": "", "\t": "  ", "WO": " w", "th": "q  r ",
}
MAP = compiled({k.encode(): v.encode() for k, v in RULES.items()})
f = pieces.field
VARIANTS = {
    "as it is": b"",
    "no prefix": f(3, f(3, 0)),
    "extra removed": f(3, f(4, 1)),
    "not escaped": f(3, f(5, 0)),
    "suffix": f(2, f(24, 1)) + f(3, f(4, 1)),
    "map": f(3, f(2, MAP)),
    "map, extra removed": f(3, f(2, MAP) + f(4, 1)),
    "map, no prefix, extra removed": f(3, f(2, MAP) + f(3, 0) + f(4, 1)),
    "symbols": f(1, f(1, b"<x>") + f(3, 4)) + f(1, f(1, b"WOR") + f(3, 4)) + f(3, f(2, MAP)),
}
#: The same pieces without those for single bytes, so that characters can be unknown.
NO_BYTES = b"".join(f(n, f(1, dict(pieces.fields(v))[1]) if n == 1 and dict(pieces.fields(v)).get(3) == 6 else v) for n, v in pieces.fields(MODEL))
PROTOS = {name: MODEL + more for name, more in VARIANTS.items()} | {"unknown": NO_BYTES + f(2, f(35, 0))}


def by_library(library, text):
    found = library.encode(text, return_type="offset_mapping")
    return found["ids"], [tuple(x) for x in found["offsets"]]


def random_texts(seed, n):
    rng = random.Random(seed)
    for i in range(n):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40))).encode()
        yield bytes(rng.choice(text + b"\xff\x80\xe2") for _ in text) if i % 4 == 0 else text


@pytest.mark.parametrize("variant", PROTOS)
def test_ids_and_spans_equal_the_library(variant, monkeypatch):
    proto = PROTOS[variant]
    model, library = pieces.PieceModel(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)
    for part in (1 << 20, 7):
        monkeypatch.setattr(pieces, "PART", part)
        for text in random_texts(part, 1500):
            ids, starts, ends = model.encode(text)
            assert (ids[1:-1].tolist(), list(zip(starts[1:-1].tolist(), ends[1:-1].tolist()))) == by_library(library, text), text
            assert (starts[0], ends[0], starts[-1], ends[-1]) == (0, 0, len(text), len(text))


def test_longest_rule_wins():
    model = pieces.Normaliser(pieces.Rules(character_map=MAP, dummy_prefix=False, remove_extra=False))
    assert model("abcab".encode())[0] == "zX▁Y".encode()
    assert model("Åb½".encode())[1].tolist() == [0, 0, 2, 3, 3, 3, 5]


def test_query_equals_the_library(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    rows = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = queries.op11_sentencepiece(spark, sf_dir).collect()
    assert len(got) == len(rows)
    digest = lambda *x: hashlib.sha256(b"".join(x)).hexdigest()
    for r in got:
        ids = library.encode(rows[r.doc_id], add_bos=True, add_eos=True)
        text = library.decode(ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == digest(text.encode())
        spans = np.array([(0, 0), *by_library(library, rows[r.doc_id].encode())[1], (len(rows[r.doc_id].encode()),) * 2], "<i4")
        assert r.spans_sha256 == digest(spans[:, 0].tobytes(), spans[:, 1].tobytes())


def test_rows_of_every_kind_and_the_way_back(spark, monkeypatch):
    monkeypatch.setattr(pieces, "HANDED_ON", 50)
    rows = [("a", None, 1), ("b", "", 2), (None, "Hello  wörld 語🎉", 3), ("a", "Hello", 4), ("c", "x" * 100_000, 5), ("d", " ▁ \n", 6)]
    made = spark.createDataFrame(rows, "doc_id string, text string, ids int").repartition(2)
    encoded = pieces.encode_documents(made, MODEL)
    got = {(r.doc_id, r.n_tokens): r for r in encoded.collect()}
    assert len(got) == len(rows)
    assert (got["a", 2].ids, got["a", 2].starts, got["a", 2].ends) == ([1, 2], [0, 0], [0, 0]) and got["b", 2].ids == [1, 2]
    r = got["a", 3]
    assert (r.starts, r.ends) == ([0, 0, 5], [0, 5, 5])
    back = sorted((r.doc_id or "", r.decoded) for r in pieces.decode_documents(encoded, MODEL).collect())
    packed = pieces.encode_documents(made, MODEL, packed=True, decoded=True)
    assert sorted((r.doc_id or "", r.decoded) for r in packed.collect()) == back
    assert sorted((r.doc_id or "", r.decoded) for r in pieces.decode_documents(packed, MODEL).collect()) == back
    assert back == sorted((k or "", (t or "").replace("▁", " ")) for k, t, _ in rows)
    assert pieces.digests(made.limit(0), MODEL).count() == 0
    ids = spark.createDataFrame([(1, None), (2, []), (3, [1, 22557, 2])], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in pieces.decode_documents(ids, MODEL).collect()} == {1: None, 2: "", 3: "Hello"}
