import hashlib
import zlib

import numpy as np
import pytest

from docspark.llm import media


def test_lookup_tables():
    assert media.MULAW_PCM[[0, 127, 128, 255]].tolist() == [-32124, 0, 32124, 0]
    assert media.ALAW_PCM[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]
    for table in (media.MULAW_PCM, media.ALAW_PCM):
        assert np.abs(table[:128].astype(int) + table[128:]).max() == 0


def one_by_one(block):
    value, index = int(np.frombuffer(block[:2], "<i2")[0]), block[2]
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(media.IMA_STEPS[index])
            change = step // 8 + (step // 4 if code & 1 else 0) + (step // 2 if code & 2 else 0) + (step if code & 4 else 0)
            value = max(-32768, min(32767, value - change if code & 8 else value + change))
            index = max(0, min(88, index + int(media.INDEX_MOVES[code & 7])))
            out.append(value)
    return out


def test_adpcm_blocks():
    blocks = np.random.default_rng(0).integers(0, 256, (9, 64), dtype=np.uint8)
    blocks[:, 2] %= 89
    assert media.adpcm(blocks).tolist() == [one_by_one(bytes(b)) for b in blocks]
    raw = media.wav(blocks.tobytes() + b"abc", media.ADPCM, 8000, block=64, bits=4)
    rate, pcm = media.expand(raw)
    assert rate == 8000 and pcm.tolist() == [x for b in blocks for x in one_by_one(bytes(b))]


@pytest.mark.parametrize("tag", [media.MULAW, media.ALAW, media.PCM])
@pytest.mark.parametrize("n", [0, 1, 64, 1001])
def test_files_keep_their_samples(tag, n):
    data = bytes(np.random.default_rng(n).integers(0, 256, 2 * n, dtype=np.uint8))
    assert bytes(media.read_wav(media.wav(data, tag, 8000))[3]) == data
    for broken in (b"", b"RIFF", media.wav(data, tag, 8000)[:30]):
        with pytest.raises(ValueError):
            media.read_wav(broken)


@pytest.mark.parametrize("rate, target", [(8000, 16000), (44100, 16000), (16000, 8000), (8000, 11025)])
def test_resample(rate, target, monkeypatch):
    pcm = np.random.default_rng(0).integers(-30000, 30000, 3000).astype(np.int16)
    whole = media.resample(pcm, rate, target)
    monkeypatch.setattr(media, "PIECE", 500)
    assert (media.resample(pcm, rate, target) == whole).all()
    t = np.arange(4000) / rate
    tone = (10_000 * np.sin(2 * np.pi * 300 * t)).astype(np.int16)
    want = 10_000 * np.sin(2 * np.pi * 300 * np.arange(len(media.resample(tone, rate, target))) / target)
    assert np.abs(media.resample(tone, rate, target) - want)[100:-100].max() < 150


def test_query_rows(hostile):
    got = media.digests(hostile).collect()
    assert len(got) == hostile.count()
    by = {r["doc_id"]: r for r in got}
    for r in hostile.collect():
        raw = (r["text"] or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        g = by[r["doc_id"]]
        assert (g["n_bytes"], g["payload_bytes"]) == (len(raw), len(payload))
        assert g["payload_sha256"] == hashlib.sha256(payload).hexdigest() and g["tail_crc32"] == zlib.crc32(payload[-64:])
        stored = media.wav(payload, media.MULAW, media.RATE)
        assert (g["media_bytes"], g["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        pcm = media.resample(media.MULAW_PCM[np.frombuffer(payload, np.uint8)], 8000, 16000)
        assert g["feature"].endswith(f"crc32 {zlib.crc32(pcm.astype('<i2').tobytes()):08x}")
    assert media.digests(hostile.limit(0)).count() == 0


def test_unreadable_media(spark):
    df = spark.createDataFrame([(1, 3, None), (2, 3, bytearray(b"junk"))], "doc_id long, n_bytes long, media binary")
    assert [(r["payload"], r["pcm"]) for r in media.to_pcm(df).collect()] == [(None, None)] * 2


def test_a_short_last_block_of_adpcm():
    data = bytes(np.random.default_rng(3).integers(0, 88, 500, dtype=np.uint8))
    _, pcm = media.expand(media.wav(data, media.ADPCM, 8000, block=64, bits=4))
    assert pcm.tolist() == [x for lo in range(0, 500, 64) for x in one_by_one(data[lo : lo + 64])]
    assert len(pcm) == 7 * 121 + (52 - 4) * 2 + 1


def test_pcm_is_stored_and_read_back(hostile, tmp_path):
    heard = media.to_pcm(media.store(hostile, str(tmp_path / "media")))
    back = media.store_pcm(heard, str(tmp_path / "pcm"))
    want = sorted(((r["doc_id"], bytes(r["pcm"])) for r in heard.collect()), key=str)
    assert sorted(((r["doc_id"], bytes(r["pcm"])) for r in back.collect()), key=str) == want
    assert {r["rate"] for r in back.collect()} == {media.TARGET}
