"""Token counts of whole texts: the library encodes in batches, only lengths come back.

Batches handed to the library hold about as many bytes each, whatever the lengths of the texts.
Long texts are cut where no piece of the model can reach over the cut, so the counts of the
parts add up to the count of the whole; the parts are dealt out as rows of their own. The
model file is read on the driver and goes to the executors as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import Scratch

SPACE = "▁"
#: Texts of more bytes are cut into parts of about so many characters.
LONG_BYTES = 65536
PART_CHARS = 32768
#: Bytes handed to the library at once.
BATCH_BYTES = 1 << 20
MOST_TOKENS = 4096
#: Set in front of a part to take the place of the space the library adds at a text's start.
SEPARATOR = "\n"


def default_model() -> str:
    """Where the installed vocabulary files have the model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Counter:
    """Encoder of one task."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self.encoder = SentencePieceProcessor(model_proto=model)
        self._pairs: set[str] | None = None

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.encoder.encode(texts, num_threads=1)]

    def part_counts(self, parts: list[str], follows: list[bool]) -> list[int]:
        """Counts of the parts of cut texts; follows tells the parts that are no text's first."""
        extra = self.counts([SEPARATOR])[0]
        marked = [SEPARATOR + part if later else part for part, later in zip(parts, follows, strict=True)]
        return [n - extra * later for n, later in zip(self.counts(marked), follows, strict=True)]

    @property
    def pairs(self) -> set[str]:
        """Neighbouring characters inside any piece; elsewhere no piece reaches over."""
        if self._pairs is None:
            model, pairs = self.encoder, set()
            for number in range(model.get_piece_size()):
                if not (model.is_byte(number) or model.is_control(number) or model.is_unknown(number)):
                    piece = model.id_to_piece(number)
                    pairs.update(piece[at : at + 2] for at in range(len(piece) - 1))
            self._pairs = pairs
        return self._pairs

    def cut(self, text: str, size: int = PART_CHARS) -> Iterator[str]:
        """Parts of at least size characters, except the last, each up to the next safe place.

        A run of characters without any safe place stays whole.
        """
        pairs, start, stop = self.pairs, 0, len(text)
        while stop - start > size:
            at = start + size
            while at < stop and text[at - 1 : at + 1].replace(" ", SPACE) in pairs:
                at += 1
            if at == stop:
                break
            yield text[start:at]
            start = at
        yield text[start:]


def _check(model: bytes) -> None:
    """The cut is exact for models that merge pieces and take texts as they are."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    normaliser = proto.normalizer_spec
    if (
        proto.trainer_spec.model_type != 2
        or normaliser.precompiled_charsmap
        or normaliser.remove_extra_whitespaces
        or not normaliser.add_dummy_prefix
        or any(SEPARATOR in piece.piece or piece.type == 4 for piece in proto.pieces)
    ):
        raise ValueError("long texts can only be cut for a BPE model without normaliser and own symbols")


def by_bytes(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """Slices of consecutive texts of at most that many bytes, or of one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and held + size > most:
            yield texts.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < len(texts):
        yield texts.slice(start)


def count_tokens(docs: DataFrame, model_file: str | None = None, limit: int = MOST_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than limit tokens) of every row of docs.

    n_tokens is the length of what the SentencePiece library gives for the whole text, without
    begin and end tokens; strings like '<s>' in a text are ordinary text to it. Null and empty
    texts have no bytes and no tokens. Repeated rows and null ids are counted each; an empty
    table gives no rows; columns other than doc_id and text are not looked at. Runs a job when
    called, which writes the parts of long texts.
    """
    with open(model_file or default_model(), "rb") as file:
        model = file.read()
    _check(model)
    scratch = Scratch(docs.sparkSession, "token-counts")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    is_long = F.col("n_bytes") > LONG_BYTES

    @F.arrow_udf("long")
    def text_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(model)
        for batch in batches:
            counts: list[int] = []
            for texts in by_bytes(batch):
                counts += counter.counts([text or "" for text in texts.to_pylist()])
            yield pa.array(counts, pa.int64())

    @F.arrow_udf("long")
    def part_tokens(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        counter = Counter(model)
        for parts, follows in batches:
            counts, at = [], 0
            for texts in by_bytes(parts):
                later = follows.slice(at, len(texts)).to_pylist()
                counts += counter.part_counts(texts.to_pylist(), later)
                at += len(texts)
            yield pa.array(counts, pa.int64())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model)
        for batch in batches:
            for row, doc_id, size, text in zip(*[batch[name] for name in batch.schema.names], strict=True):
                for number, part in enumerate(counter.cut(text.as_py())):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row.as_py()], pa.int64()),
                            pa.array([doc_id.as_py()], pa.int64()),
                            pa.array([size.as_py()], pa.int64()),
                            pa.array([number > 0]),
                            pa.array([part], pa.string()),
                        ],
                        names=["row", "doc_id", "n_bytes", "follows", "part"],
                    )

    # the number of a row is fixed by writing it, together with all parts of the text
    numbered = base.filter(is_long).select(F.monotonically_increasing_id().alias("row"), "*")
    parts = scratch.table(
        numbered.mapInArrow(cut, "row long, doc_id long, n_bytes long, follows boolean, part string")
        .repartition(F.xxhash64("row", "part")),
        "parts",
    )
    long_texts = (
        parts.select("row", "doc_id", "n_bytes", part_tokens("part", "follows").alias("n_tokens"))
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_bytes").alias("n_bytes"),
            F.sum("n_tokens").alias("n_tokens"),
        )
        .drop("row")
    )
    short_texts = base.filter(~is_long).select(
        "doc_id", "n_bytes", text_tokens("text").alias("n_tokens")
    )
    return short_texts.unionByName(long_texts).withColumn(
        "over_limit", F.col("n_tokens") > F.lit(limit)
    )
