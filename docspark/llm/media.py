"""Telephony audio in media columns: mu-law, A-law and ADPCM to 16-bit PCM, resampled."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import buffers, narrowed
from docspark.runtime import work_path

# Format tags of WAV files.
PCM, ALAW, MULAW, ADPCM = 1, 6, 7, 17
#: Rate of telephony samples, and of the PCM made from them.
RATE, TARGET = 8000, 16000
#: A payload is filled up with zero bytes to a positive multiple of this.
UNIT = 64
#: Samples resampled at a time.
PIECE = 1 << 18
#: Bytes of PCM in one batch of rows.
BATCH = 16 << 20

# How the index of IMA ADPCM moves with a code's size, and its step sizes.
INDEX_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8])
IMA_STEPS = np.array(
    [
        *[7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118],
        *[130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060],
        *[1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484],
        *[7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    ]
)
N_STEPS = len(IMA_STEPS)


def mulaw_table() -> np.ndarray:
    """16-bit value of each mu-law byte (G.711): bits are inverted; sign, 3 bits of segment, 4 of step."""
    code = ~np.arange(256, dtype=np.uint8)
    segment, step = (code >> 4) & 7, (code & 15).astype(np.int64)
    size = ((2 * step + 33) << segment) - 33
    return np.where(code & 128, -size * 4, size * 4).astype(np.int16)


def alaw_table() -> np.ndarray:
    """16-bit value of each A-law byte (G.711): every other bit is inverted; segment 0 is linear."""
    code = np.arange(256, dtype=np.uint8) ^ 0x55
    segment, step = ((code >> 4) & 7).astype(np.int64), (code & 15).astype(np.int64)
    size = np.where(segment == 0, 2 * step + 1, (2 * step + 33) << np.maximum(segment - 1, 0))
    return np.where(code & 128, size * 8, -size * 8).astype(np.int16)


MULAW_PCM, ALAW_PCM = mulaw_table(), alaw_table()


def adpcm(blocks: np.ndarray) -> np.ndarray:
    """PCM of IMA ADPCM blocks (one channel), a row each: first sample (i2), step index (u1), one byte, 4-bit codes.

    Samples of a block depend on each other, blocks do not: each step handles one code of all blocks.
    """
    head = np.ascontiguousarray(blocks[:, :4])
    value = head[:, :2].copy().view("<i2").ravel().astype(np.int64)
    index = np.clip(head[:, 2].astype(np.int64), 0, N_STEPS - 1)
    codes = np.stack([blocks[:, 4:] & 15, blocks[:, 4:] >> 4], axis=2).reshape(len(blocks), -1)
    out = np.empty((len(blocks), codes.shape[1] + 1), np.int16)
    out[:, 0] = value
    for k in range(codes.shape[1]):
        code = codes[:, k].astype(np.int64)
        step = IMA_STEPS[index]
        change = (step >> 3) + (step >> 2) * (code & 1) + (step >> 1) * (code >> 1 & 1) + step * (code >> 2 & 1)
        value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + INDEX_MOVES[code & 7], 0, N_STEPS - 1)
        out[:, k + 1] = value
    return out


def wav(data: bytes, tag: int, rate: int, block: int = 1, bits: int = 8) -> bytes:
    """A WAV file of one channel around sample data, which is kept byte for byte."""
    extra = b"" if tag == PCM else struct.pack("<HH", 2, (block - 4) * 2 + 1) if tag == ADPCM else struct.pack("<H", 0)
    per_block = (block - 4) * 2 + 1 if tag == ADPCM else 1
    form = struct.pack("<HHIIHH", tag, 1, rate, rate * block // per_block, block, bits) + extra
    fact = b"" if tag == PCM else b"fact" + struct.pack("<II", 4, len(data) // block * per_block)
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + fact + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(raw: bytes) -> tuple[int, int, int, memoryview]:
    """(format tag, rate, block size, sample data) of a WAV file of one channel."""
    view = memoryview(raw)
    if bytes(view[:4]) != b"RIFF" or bytes(view[8:12]) != b"WAVE":
        raise ValueError("not a WAV file")
    at, form = 12, None
    while at + 8 <= len(view):
        name, size = bytes(view[at : at + 4]), struct.unpack("<I", view[at + 4 : at + 8])[0]
        body = view[at + 8 : at + 8 + size]
        if len(body) < size:
            break
        if name == b"fmt " and size >= 16:
            form = struct.unpack("<HHIIHH", body[:16])
        elif name == b"data" and form:
            if form[1] != 1:
                raise ValueError("more than one channel")
            return form[0], form[2], form[4], body
        at += 8 + size + size % 2
    raise ValueError("no sample data")


def expand(raw: bytes) -> tuple[int, np.ndarray]:
    """(rate, 16-bit PCM) of a WAV file in any of the four formats. A short last ADPCM block gives the samples it has."""
    tag, rate, block, data = read_wav(raw)
    if tag == PCM:
        return rate, np.frombuffer(data, "<i2")
    if tag in (MULAW, ALAW):
        return rate, (MULAW_PCM if tag == MULAW else ALAW_PCM)[np.frombuffer(data, np.uint8)]
    if tag == ADPCM:
        codes = np.frombuffer(data, np.uint8)
        whole = len(codes) // block * block
        rest = codes[whole:]
        # without its head a block says nothing
        tail = adpcm(rest.reshape(1, -1)).ravel() if len(rest) >= 4 else np.empty(0, np.int16)
        return rate, np.concatenate([adpcm(codes[:whole].reshape(-1, block)).ravel(), tail])
    raise ValueError(f"format {tag} is not known")


def kernel(up: int, down: int, half: int = 8) -> np.ndarray:
    """Windowed-sinc weights by phase: (up, 2 * half), each row adding up to 1."""
    cut = min(1.0, up / down)
    t = np.arange(-half + 1, half + 1)[None, :] - (np.arange(up) / up)[:, None]
    w = cut * np.sinc(cut * t) * np.cos(np.pi * t / (2 * half + 2)) ** 2
    return (w / w.sum(axis=1, keepdims=True)).astype(np.float32)


def resample(pcm: np.ndarray, rate: int, target: int) -> np.ndarray:
    """PCM at another rate, a piece at a time; samples beyond the ends count as the end's."""
    if rate == target or not len(pcm):
        return pcm.astype(np.int16)
    common = np.gcd(rate, target)
    up, down = int(target // common), int(rate // common)
    weights = kernel(up, down)
    taps = weights.shape[1]
    half = taps // 2
    out = np.empty(-(-len(pcm) * up // down), np.int16)
    piece = max(1, PIECE // up) * up
    for lo in range(0, len(out), piece):
        n = min(piece, len(out) - lo)
        first, last = lo // up * down, (lo + n - 1) * down // up
        part = pcm[np.clip(np.arange(first - half + 1, last + half + 1), 0, len(pcm) - 1)].astype(np.float32)
        for p in range(min(up, n)):
            # outputs of one phase lie ``down`` inputs apart
            at, count = p * down // up, -(-(n - p) // up)
            total = np.zeros(count, np.float32)
            for k, w in enumerate(weights[p * down % up]):
                total += w * part[at + k : at + k + (count - 1) * down + 1 : down]
            out[lo + p : lo + n : up] = np.clip(np.rint(total), -32768, 32767)
    return out


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a media column and read it back: doc_id, n_bytes, media.

    ``media`` is a mu-law WAV file whose 8-bit samples are the UTF-8 bytes of ``text``, filled up with zero bytes to a
    positive multiple of ``UNIT``. A null text is empty. Rows that repeat give rows that repeat, a null id stays null,
    other columns are ignored, an empty table gives an empty one.
    """
    docs = narrowed(df, doc_id="bigint", text="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            media = []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                fill = UNIT if a == b else -int(b - a) % UNIT
                media.append(wav(data[a:b].tobytes() + b"\0" * fill, MULAW, RATE))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    made = docs.mapInArrow(run, "doc_id long, n_bytes long, media binary")
    made.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path)


def to_pcm(df: DataFrame, target: int = TARGET) -> DataFrame:
    """``payload`` (the samples as stored) and ``pcm`` (16-bit, at ``target``) of each (doc_id, n_bytes, media).

    A null or unreadable file has neither. Rows leave in batches of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "media", "payload", "pcm"]
        for batch in batches:
            lo, held, payloads, pcms = 0, 0, [], []

            def rows(lo: int, batch=batch) -> pa.RecordBatch:
                part = batch.slice(lo, len(pcms))
                cols = [part.column(n) for n in names[:3]]
                return pa.RecordBatch.from_arrays([*cols, pa.array(payloads, pa.binary()), pa.array(pcms, pa.binary())], names)

            for value in batch.column("media"):
                raw, payload, pcm = value.as_py(), None, None
                try:
                    if raw is not None:
                        rate, samples = expand(raw)
                        payload, pcm = bytes(read_wav(raw)[3]), resample(samples, rate, target).astype("<i2").tobytes()
                except ValueError:
                    pass
                payloads.append(payload)
                pcms.append(pcm)
                held += len(pcm or b"")
                if held >= BATCH:
                    yield rows(lo)
                    lo, held, payloads, pcms = lo + len(pcms), 0, [], []
            if pcms:
                yield rows(lo)

    kinds = "doc_id long, n_bytes long, media binary, payload binary, pcm binary"
    return narrowed(df, doc_id="bigint", n_bytes="bigint", media="binary").mapInArrow(run, kinds)


def store_pcm(heard: DataFrame, path: str) -> DataFrame:
    """Write the resampled PCM of (doc_id, n_bytes, media, payload, pcm) and read it back: doc_id, n_bytes, rate, pcm."""
    made = heard.select("doc_id", "n_bytes", F.lit(TARGET).alias("rate"), "pcm")
    made.write.option("compression", "zstd").parquet(path)
    return heard.sparkSession.read.schema(made.schema).parquet(path)


def digests(df: DataFrame) -> DataFrame:
    """Sizes and digests of texts that were stored as media, read back, expanded and resampled.

    The PCM is digested as it is made: ``store_pcm`` would take 4.9 times the bytes of the documents' table.
    """
    heard = to_pcm(store(df, work_path(df.sparkSession, "media")))
    seconds = F.octet_length("pcm") / (2 * TARGET)
    feature = F.format_string("pcm16 %d Hz, %.3f s, crc32 %08x", F.lit(TARGET), seconds, F.crc32("pcm"))
    tail = F.substring("payload", -UNIT, UNIT)
    return heard.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(tail).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
    )
