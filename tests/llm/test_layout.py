"""Sharding, mixing and token records next to brute force."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkweave.llm import mixing, sharding, token_records
from linkweave.session import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    one = sharding.Feistel(size)
    places = one.place(np.arange(size))
    assert sorted(places) == list(range(size))
    assert (one.number(places) == np.arange(size)).all()
    if size >= 1000:
        assert (sharding.Feistel(size, seed=1).place(np.arange(size)) != places).mean() > 0.9
        assert abs(np.corrcoef(places, np.arange(size))[0, 1]) < 0.1


def test_shards(docs):
    rows = [(n * 3, f"text {n % 7}") for n in range(100)]
    rows += [(3, "text 1"), (3, "other"), (None, None), (None, "x"), (6, ""), (9, "é" * 5000)]
    found = sharding.shard(docs(rows)).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in found) == sorted(
        (d or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    order = sorted(found, key=lambda r: r.row_number)
    assert [r.row_number for r in order] == list(range(len(rows)))
    keys = [(r.doc_id is not None, r.doc_id, r.text_crc32, r["size"]) for r in order]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0, k[2], k[3]))
    permutation = sharding.Feistel(len(rows))
    for r in order:
        assert sharding.row_at(permutation, r.shard, r.slot) == r.row_number
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, [])) for k in range(16)]
    assert max(counts) - min(counts) <= 1
    again = sharding.shard(docs(rows).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    whole = sharding.shard_documents(docs(rows))
    assert whole.columns == [*docs(rows).columns, "shard", "slot"]
    assert {(r.doc_id, r.text, r.shard, r.slot) for r in whole.where("doc_id > 9").collect()} == {
        (r.doc_id, dict(rows)[r.doc_id], r.shard, r.slot) for r in found if (r.doc_id or 0) > 9
    }
    assert sharding.shard(docs(rows[:0] or rows).limit(0)).count() == 0


def brute_targets(sizes, weights=(5, 2, 1), repeats=3):
    names = sorted((s for s in sizes if s is not None), key=str.encode)
    names += [None] if None in sizes else []
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, targets, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(targets.values())
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > repeats * sizes[s] + 1e-9]
        if not over:
            targets |= {s: level * weight[s] for s in free}
            break
        for s in over:
            targets[s] = repeats * sizes[s]
            free.discard(s)
    return targets


@pytest.mark.parametrize("slots", [1 << 20, 300])
def test_mixing(docs, slots):
    chance = np.random.default_rng(slots)
    sources = ["a", "b", "é", "", None, "tiny", "z"]
    rows = [
        (n, " ".join(["w"] * int(chance.integers(0, 60))), sources[int(chance.integers(0, 5))])
        for n in range(400)
    ]
    rows += [(1000, "one two", "tiny"), (1001, None, "z"), (None, "a b c", "a"), (None, "a b c", "a")]
    rows += [(1002, "w " * 3000, "b"), (5, rows[5][1], rows[5][2])]
    found = mixing.mix_sources(docs(rows), slots=slots).collect()
    assert len(found) == len(rows)
    sizes, taken, target = {}, {}, {}
    of = {}
    for d, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
        of[d] = s
    for r in found:
        s = of[r.doc_id]
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[s]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    wanted = brute_targets(sizes)
    block = max(1, sum(sizes.values()) // slots)
    for s in sizes:
        assert target[s] == pytest.approx(wanted[s])
        assert abs(taken[s] - wanted[s]) <= 4 * block + 2, s
    again = mixing.mix_sources(docs(rows).repartition(3), slots=slots).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mixing_as_rows(docs):
    rows = [(n, "w " * 20, "a" if n % 4 else "b") for n in range(200)] + [(900, None, "a")]
    table = docs(rows)
    mixed = mixing.repeat_documents(table)
    assert mixed.columns == table.columns
    counts = {s: 0 for s in "ab"}
    for r in mixed.collect():
        counts[r.source] += 20
    # b has weight 2 of 7 and a quarter of the words.
    wanted = brute_targets({"a": 3000, "b": 1000})
    assert all(abs(counts[s] - wanted[s]) <= 20 for s in "ab")
    assert mixing.repeat_documents(table.limit(0)).count() == 0
    assert mixing.mix_sources(docs([(1, None), (2, "")])).count() == 2


def test_mixing_as_rows_without_ids(docs):
    """Null and repeated ids in a scarce and a plentiful source, each with its own counts."""
    rows = [(None if n % 3 else 5, f"t{n} " + "w " * (n % 7 + 9), "a" if n % 8 else "b") for n in range(1_600)]
    sizes, taken = {"a": 0, "b": 0}, {"a": 0, "b": 0}
    for _, text, source in rows:
        sizes[source] += len(text.split())
    times = {}
    for r in mixing.repeat_documents(docs(rows)).collect():
        taken[r.source] += len(r.text.split())
        times[r.text] = times.get(r.text, 0) + 1
    wanted = brute_targets(sizes)
    assert wanted["a"] < sizes["a"] and wanted["b"] > sizes["b"]
    assert all(abs(taken[s] - wanted[s]) <= 0.05 * wanted[s] for s in "ab"), (taken, wanted)
    assert max(times.values()) <= 3


def odd_texts():
    chance = np.random.default_rng(5)
    alphabet = [*"aA'sIİßΣςσ \t\n\x0b\x0c\r\x1c\x85  éé́́1२<>.,!-‍👩", "<|endoftext|>", "'s", "don't"]
    return ["".join(chance.choice(alphabet, int(chance.integers(0, 40)))) for _ in range(300)]


def test_words_are_encoded_as_in_the_whole_text():
    ids, tokenizer = token_records.WordIds(VOCABULARY, "<u4"), Tokenizer.from_file(VOCABULARY)
    for text in odd_texts():
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.text(text) == np.array(whole, "<u4").tobytes(), repr(text)


def test_other_vocabularies_encode_whole_texts():
    other = public_tokenizers.path("byte_bpe_50k.json")
    ids, tokenizer = token_records.WordIds(other, "<u4"), Tokenizer.from_file(other)
    assert not ids.by_words and token_records.WordIds(VOCABULARY, "<u4").by_words
    for text in [*odd_texts(), None]:
        whole = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids.text(text) == np.array(whole, "<u4").tobytes(), repr(text)


def test_one_doc_id_in_many_files(spark, docs):
    """Most rows without a doc_id: they are dealt over files and stay in order."""
    rows = [(None if n % 4 else n, f"{n * 37 % 400} and more") for n in range(400)]
    folder = scratch_path(spark, "records")
    manifest = token_records.write_records(docs(rows), folder, VOCABULARY, file_bytes=500)
    found = sorted(token_records.read_records(manifest, folder).collect(), key=lambda r: r.start)
    assert len({r.name for r in found if r.doc_id is None}) > 2
    tokenizer, start = Tokenizer.from_file(VOCABULARY), 0
    wanted = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for r, (doc_id, text) in zip(found, wanted, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), crc)
        start += len(ids)


def test_folders_are_on_the_default_file_system(spark, tmp_path):
    named = token_records.qualified(spark, str(tmp_path))
    assert named == f"file:{tmp_path}"
    assert token_records._open(named)[1] == str(tmp_path)


def test_frames():
    record = token_records.frame(b"payload")
    assert struct.unpack_from("<Q", record)[0] == 7
    assert token_records.unframe(record) == b"payload"
    for at in range(len(record)):
        damaged = bytearray(record)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(bytes(damaged))


def test_records(spark, docs):
    rows = [(n * 7 % 311, t) for n, t in enumerate(odd_texts())] + [(400, None), (None, "x"), (5, "y"), (401, "w " * 30_000)]
    table, folder = docs(rows), scratch_path(spark, "records")
    manifest = token_records.write_records(table, folder, VOCABULARY, file_bytes=20_000)
    assert manifest.count() > 2
    found = token_records.read_records(manifest, folder).collect()
    tokenizer, start, wanted = Tokenizer.from_file(VOCABULARY), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == [
        (s, d, n, c) for d, s, n, c in wanted
    ]
    entry = manifest.orderBy("file").first()
    doc_id, ids = token_records.read_record(folder, entry["name"], 1, entry["kind"])
    assert (doc_id, len(ids)) == (wanted[1][0], wanted[1][2])
    assert token_records.encode_documents(table.limit(0), VOCABULARY).count() == 0


def test_mixing_of_a_hot_id(docs, monkeypatch):
    """Null and repeated ids over many rows of one size, dealt in stretches, as one by one."""
    rows = [(None, "w " * 9, "a")] * 300 + [(7, "w " * 4, "b")] * 200 + [(7, None, "b")] * 50
    rows += [(n, "w " * (n % 5), "ab"[n % 2]) for n in range(100)]
    found = []
    for stretch in (1 << 16, 7, 1):
        monkeypatch.setattr(mixing, "EQUAL_ROWS", stretch)
        found.append(sorted(map(str, mixing.mix_sources(docs(rows)).collect())))
    assert len(found[0]) == len(rows) and found[0] == found[1] == found[2]
