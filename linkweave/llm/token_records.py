"""Token ids in length-delimited binary files, with an offset index beside each.

A record is the payload's length (8 bytes), a masked checksum of that length (4), the
payload, and a masked checksum of the payload (4); all numbers are little-endian. The
payload holds the doc_id, 0 or 1 for a null one, and the token ids, two bytes each if the
vocabulary fits and four otherwise. The index has a fixed-size entry per record, so that
the n-th record is found with two short reads.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkweave.llm.text import record_batches, texts_of
from linkweave.session import scratch_path, settled

END_ID = 1

# Input bytes per file, which is also what a task reads: the least and the most. Between
# them the input is cut into this many files.
FILE_BYTES = (16_000_000, 1_000_000_000)
FILES = 4_096

# First characters of a text by which rows with the same doc_id are dealt over files.
HEAD_CHARS = 64

# Words whose ids a worker keeps; an entry takes about 200 bytes.
CACHED_WORDS = 500_000

# Fixed value: added to the rotated checksum in masking.
MASK_DELTA = 0xA282EAD8

_HEAD = "<QI"
_TAIL = "<I"
_OWNER = "<qB"
_ENTRY = "<QQQ"  # offset, bytes of the record, tokens before it in the file


def masked(data: bytes) -> int:
    """A checksum that stays sound when it is itself stored in checked data."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return struct.pack(_HEAD, len(payload), masked(length)) + payload + struct.pack(_TAIL, masked(payload))


def unframe(record: bytes) -> bytes:
    """The payload of one record; an error if a checksum does not match."""
    size, check = struct.unpack_from(_HEAD, record)
    payload = record[struct.calcsize(_HEAD) : struct.calcsize(_HEAD) + size]
    if masked(record[:8]) != check or len(record) != struct.calcsize(_HEAD) + size + struct.calcsize(_TAIL):
        raise ValueError("the length of a record is damaged")
    if struct.unpack_from(_TAIL, record, struct.calcsize(_HEAD) + size)[0] != masked(payload):
        raise ValueError("a record is damaged")
    return payload


# How the vocabulary of `WordIds` prepares a text.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {
                "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            },
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def encodes_by_words(tokenizer: Tokenizer) -> bool:
    """Whether the ids of a text are those of its words, one after the other."""
    known = json.loads(tokenizer.to_str())
    return (
        known["normalizer"] == NORMALIZER
        and known["pre_tokenizer"] == PRE_TOKENIZER
        and known["model"]["type"] == "BPE"
        and not known["model"]["dropout"]
        and not known["truncation"]
        and not known["padding"]
        and not any(t["single_word"] or t["normalized"] for t in known["added_tokens"])
    )


class WordIds(dict):
    """Token ids of words, as bytes.

    A vocabulary that prepares texts as `NORMALIZER` and `PRE_TOKENIZER` say drops white
    space before it merges anything, so that the ids of a text are those of its words one
    after the other. A word of visible ASCII and Latin-1 letters is cut into its pieces here
    as the vocabulary's own pattern does, and each piece is merged once; any other word goes
    through the whole tokenizer. So does each whole text if the vocabulary is another one.
    """

    # Fixed value: the pattern of the vocabulary's pieces, for words of these letters.
    PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")

    def __init__(self, path: str, kind: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = encodes_by_words(self.tokenizer)
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in special) or "(?!)")
        self.kind = kind
        self.pieces: dict[str, bytes] = {}
        # Fixed value: the letters that stand for bytes in the vocabulary; visible bytes
        # stand for themselves, the others follow from 256 on.
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.letters = {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(hidden)}

    def _merged(self, piece: str) -> bytes:
        if len(self.pieces) >= CACHED_WORDS:
            self.pieces.clear()
        if not piece.isascii():
            piece_letters = "".join(map(self.letters.__getitem__, piece.encode()))
        else:
            piece_letters = piece
        ids = [t.id for t in self.tokenizer.model.tokenize(piece_letters)]
        found = self.pieces[piece] = np.array(ids, self.kind).tobytes()
        return found

    def _learn(self, words: list[bytes]) -> None:
        others, pieces = [], self.pieces
        for word in words:
            text = word.decode()
            if self.PLAIN.fullmatch(text) and not self.special.search(text):
                ids = b""
                for piece in self.PIECE.findall(text.lower()):
                    ids += pieces.get(piece) or self._merged(piece)
                self[word] = ids
            else:
                others.append(text)
        if others:
            found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
            for text, encoded in zip(others, found, strict=True):
                self[text.encode()] = np.array(encoded.ids, self.kind).tobytes()

    def text(self, text: str | None) -> bytes:
        if not self.by_words:
            encoded = self.tokenizer.encode(text or "", add_special_tokens=False)
            return np.array(encoded.ids, self.kind).tobytes()
        words = text.encode().split() if text else []
        new = {w for w in words if w not in self}
        if new:
            if len(self) + len(new) > CACHED_WORDS:
                self.clear()
                new = set(words)
            self._learn(new)
        return b"".join(map(self.__getitem__, words))


_WORD_IDS: dict[tuple[str, str], WordIds] = {}


def shared_ids(path: str, kind: str) -> WordIds:
    """The word cache of this worker process; it outlives a task."""
    if (path, kind) not in _WORD_IDS:
        _WORD_IDS[path, kind] = WordIds(path, kind)
    return _WORD_IDS[path, kind]


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a `qualified` folder, for use inside tasks."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = f"file://{folder.removeprefix('file:')}"
    return pa.fs.FileSystem.from_uri(folder)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: one without is on the cluster's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


_MANIFEST = pa.schema(
    [
        ("file", pa.int32()),
        ("name", pa.string()),
        ("records", pa.int64()),
        ("tokens", pa.int64()),
        ("bytes", pa.int64()),
    ]
)


def _write_files(folder: str, vocabulary: str, kind: str, end_id: int):
    """Write the rows of a task as one file and its index; gives the file's manifest row.

    Names are new in every attempt and the manifest lists those of the attempts that
    count, so that a repeated or lost task leaves no half-written file in use.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared_ids(vocabulary, kind)
        end = np.array([end_id], kind).tobytes()
        width = len(end)
        files, root = _open(folder)
        name = f"tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        offset = records = tokens = 0
        with (
            files.open_output_stream(f"{root}/{name}.rec", compression=None) as data,
            files.open_output_stream(f"{root}/{name}.idx", compression=None) as index,
        ):
            for batch in batches:
                owners = batch.column("doc_id").to_pylist()
                for doc_id, text in zip(owners, texts_of(batch), strict=True):
                    payload = ids.text(text) + end
                    owner = struct.pack(_OWNER, doc_id or 0, doc_id is None)
                    record = frame(owner + payload)
                    data.write(record)
                    index.write(struct.pack(_ENTRY, offset, len(record), tokens))
                    offset += len(record)
                    records += 1
                    tokens += len(payload) // width
        row = (TaskContext.get().partitionId(), name, records, tokens, offset)
        yield from record_batches([row], _MANIFEST)

    return run


def write_records(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = END_ID,
    file_bytes: int | None = None,
) -> DataFrame:
    """Write all documents in ascending order of doc_id; gives the manifest of the files.

    (file, name, records, tokens, bytes, start), start being the tokens of all files
    before. Null doc_ids come first; rows with the same doc_id are ordered by text and may
    be in several files. A null text has the end id only. Files hold about `file_bytes` of
    text; unless given, that grows with the table within `FILE_BYTES`.
    """
    size = Tokenizer.from_file(vocabulary).get_vocab_size()
    kind = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    least, most = FILE_BYTES
    parts = int(total // (file_bytes or min(most, max(least, total // FILES)))) + 1
    folder = qualified(docs.sparkSession, folder)
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    manifest = settled(
        docs.select("doc_id", "text")
        .repartitionByRange(parts, "doc_id", F.left("text", F.lit(HEAD_CHARS)))
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(
            _write_files(folder, vocabulary, kind, end_id),
            "file int, name string, records bigint, tokens bigint, bytes bigint",
        ),
        "manifest",
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).withColumn(
        "kind", F.lit(kind)
    )


_READ = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("name", pa.string()),
        ("offset", pa.int64()),
    ]
)


def read_ids(payload: bytes, kind: str) -> tuple[int | None, np.ndarray]:
    """The doc_id and the token ids of a record's payload."""
    doc_id, missing = struct.unpack_from(_OWNER, payload)
    return (None if missing else doc_id), np.frombuffer(payload, kind, offset=struct.calcsize(_OWNER))


def read_record(folder: str, name: str, number: int, kind: str) -> tuple[int | None, np.ndarray]:
    """The n-th record of a file, by its index; the folder is a `qualified` one."""
    files, root = _open(folder)
    with files.open_input_file(f"{root}/{name}.idx") as index:
        offset, size, _ = struct.unpack(_ENTRY, index.read_at(struct.calcsize(_ENTRY), number * struct.calcsize(_ENTRY)))
    with files.open_input_file(f"{root}/{name}.rec") as data:
        return read_ids(unframe(data.read_at(size, offset)), kind)


def _read_files(folder: str):
    def rows(batches):
        files, root = _open(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                name = entry["name"]
                with (
                    files.open_input_stream(f"{root}/{name}.rec", compression=None) as data,
                    files.open_input_stream(f"{root}/{name}.idx", compression=None) as index,
                ):
                    for _ in range(entry["records"]):
                        offset, size, before = struct.unpack(_ENTRY, index.read(struct.calcsize(_ENTRY)))
                        doc_id, ids = read_ids(unframe(data.read(size)), entry["kind"])
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        yield doc_id, entry["start"] + before, len(ids), crc, name, offset

    return lambda batches: record_batches(rows(batches), _READ)


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Digest of every record, read back from the files of a manifest.

    (doc_id, start, n_tokens, ids_crc32, name, offset); every checksum is tested.
    """
    return (
        manifest.repartition("file")
        .mapInArrow(
            _read_files(qualified(manifest.sparkSession, folder)),
            "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, name string, "
            "offset bigint",
        )
    )


def encode_documents(
    docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Write the documents as records and read them back, a row per input row.

    The folder is a new one in the shared scratch folder unless it is given. An empty
    table writes an empty file and gives no rows. Other columns are not read.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-records")
    manifest = settled(write_records(docs, folder, vocabulary, end_id), "manifest")
    return read_records(manifest, folder)
