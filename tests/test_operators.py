import hashlib
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lambi.functions.pieces import tokenizer
from lambi.operators import coverage, dedup, edits, profile, rules, scoring, signal, splits, vectors
from lambi.plans import catalog


def test_rate_rule_catches_runaway_text(spark):
    df = spark.createDataFrame([("wi " * 430, 2.7), ("a" * 68, 5.0), ("", 3.0), ("abc", None), ("abc", 0.1)], "text string, duration double")
    got = [r[0] for r in df.select(rules.first_failing(rules.speech_rules(F.col("text"), F.col("duration")))).collect()]
    assert got == ["implausible_chars_per_second", None, "empty_text", "undecodable_audio", "too_short"]


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 0, 9), ("a", 1, 1), (None, 0, 1), (None, 0, 2)], "k string, s int, i int")
    got = {(r["k"], r["s"], r["i"]): r["is_duplicate"] for r in dedup.mark_duplicates(df, "k", ["s", "i"]).collect()}
    assert got == {("a", 1, 5): True, ("a", 0, 9): False, ("a", 1, 1): True, (None, 0, 1): False, (None, 0, 2): True}


def corpus(spark, real, synthetic):
    rows = [(f"/r{i}", f"s{i % 12}", 4.0, False) for i in range(real)] + [(f"/s{i}", f"s{i % 12}", 4.0, True) for i in range(synthetic)]
    return spark.createDataFrame(rows, "path string, speaker string, d double, syn boolean")


@pytest.mark.parametrize("by_group", [True, False])
def test_splits_keep_synthetic_rows_in_train(spark, by_group):
    out = splits.split_corpus(corpus(spark, 60, 40), "path", "speaker", "d", "syn", by_group=by_group)
    assert {r["split_mode"] for r in out.select("split_mode").distinct().collect()} == {"group" if by_group else "hash"}
    assert out.count() == 100 and out.where("syn and split <> 'train'").count() == 0
    if by_group:
        assert out.where("not syn").groupBy("speaker").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


def test_all_synthetic_is_an_error(spark):
    with pytest.raises(ValueError):
        splits.split_corpus(corpus(spark, 0, 5), "path", "speaker", "d", "syn")


def test_oversampling_rounds_half_to_even(spark):
    df = spark.createDataFrame([("a", 2.5, "train"), ("b", 1.5, "train"), ("c", 0.2, "train"), ("d", 3.0, "val")], "k string, w double, split string")
    got = {r["k"]: r["n"] for r in splits.oversample(df, F.col("w")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"a": 2, "b": 2, "c": 1, "d": 1}


def test_error_rates(spark):
    df = spark.createDataFrame([(1, "m", "yon de twa", "yon twa <fr-FR>"), (2, "m", "Wi, mwen!", "wi mwen"), (3, "m", "", "x")], "i int, model string, reference string, hypothesis string")
    r = scoring.error_rates(df, "model").first()
    assert (r["wer"], r["clips"]) == (0.2, 2)
    assert [x["i"] for x in scoring.worst(df, "i", 1).collect()] == [1]


def test_missing_system_gives_null_delta(spark):
    df = spark.createDataFrame([("b", 80, 0.5), ("t", 80, 0.2), ("b", 320, 0.4)], "model string, latency_ms int, wer double")
    got = {r["latency_ms"]: r["delta"] for r in scoring.compare_systems(df, "b", "t").collect()}
    assert got == {80: -0.3, 320: None}


def test_records(spark):
    df = spark.createDataFrame([("9",), ("-3",), (None,), ("hot",), ("NaN",)], "v string")
    value, error = rules.clamp(F.col("v"), 0.1, 2.0, 0.8)
    assert [tuple(r) for r in df.select(value, error).collect()] == [(2.0, None), (0.1, None), (0.8, None), (None, "must be a number"), (None, "must be a number")]
    raw, error = rules.decode_payload(F.col("v"))
    df = spark.createDataFrame([("data:audio/wav;base64,YWI=",), ("YWI=",), ("*",)], "v string")
    assert [(r[0] and bytes(r[0]), r[1]) for r in df.select(raw, error).collect()] == [(b"ab", None), (b"ab", None), (None, "invalid base64")]
    mails = spark.createDataFrame([(" a@b.ht ", "n", "u"), ("nope", None, None)], "email string, note string, use_case string")
    assert [r["valid"] for r in rules.signup(mails).collect()] == [True, False]


def test_length_table(spark):
    rng = np.random.default_rng(7)
    data = [(i, 10 + int(rng.integers(0, 390)), rng.normal(size=8).tolist()) for i in range(60)]
    df = spark.createDataFrame(data, "id long, length int, vec array<double>")
    table = vectors.length_table(df, 510)
    assert table.count() == 510 * 8
    got = {(r["target"], r["dim"]): r["value"] for r in table.collect()}
    near = [v for _, n, v in data if abs(n - 100) <= 20]
    assert len(near) >= 5 and math.isclose(got[100, 3], np.mean([v[3] for v in near]))
    five = sorted(data, key=lambda r: (abs(r[1] - 1), r[0]))[:5]
    assert math.isclose(got[1, 0], np.mean([v[0] for _, _, v in five]))
    smooth = vectors.smooth_table(table).collect()
    want = np.mean([got[max(1, min(510, 3 + k)), 2] for k in range(-7, 8)])
    assert math.isclose(next(r["value"] for r in smooth if (r["target"], r["dim"]) == (3, 2)), want)
    assert vectors.check_table(table.withColumn("value", F.lit(1.0))).first()["verdict"] == "SUSPECT"
    assert vectors.check_table(table.withColumn("value", F.lit(float("nan")))).first()["warnings"][0] == "values are not finite"


def wav(x, rate):
    body = (np.clip(x, -1, 1) * 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(body)) + body


def test_signal_measures(spark):
    t = np.arange(24000) / 24000
    noise = np.random.default_rng(1).normal(size=24000) * 0.1
    rows = [(1, wav(0.5 * np.sin(2 * np.pi * 1000 * t), 24000)), (2, wav(0.5 * np.sin(2 * np.pi * 10000 * t), 24000)), (3, wav(noise, 24000)), (4, b"junk"), (5, wav(np.zeros(5000), 24000)), (6, None)]
    got = {r["i"]: r for r in signal.measure(spark.createDataFrame(rows, "i int, audio binary"), "i", "audio").collect()}
    assert got[1]["e8k"] < 1e-6 and got[2]["e8k"] > 0.999 and abs(got[3]["e8k"] - 1 / 3) < 0.03
    assert got[4]["duration"] is None and got[6]["duration"] is None and got[5]["e8k"] == 0
    assert got[1]["native_sr"] == 24000 and got[1]["duration"] == 1.0


def plain_trim(x, sr):
    level = math.sqrt(sum(v * v for v in x) / len(x)) if x else 0
    if level == 0:
        return x
    size, pad = max(1, math.floor(0.005 * sr + 0.5)), math.floor(0.02 * sr + 0.5)

    def loud(at):
        part = x[at : at + size]
        return sum(map(abs, part)) / max(1, len(part)) > max(0.05 * level, 1e-4)

    start, stop = 0, len(x)
    while start < len(x) and not loud(start):
        start += size
    while stop > start and not loud(max(0, stop - size)):
        stop -= size
    return x if stop <= start else x[max(0, start - pad) : stop + pad]


def plain_join(parts, sr):
    """A passage segment by segment, and where each starts."""
    if len(parts) == 1:
        return [parts[0]], [0]
    done = [plain_trim(list(x), sr) for x in parts]
    rms = [math.sqrt(sum(v * v for v in x) / len(x)) if x else 0 for x in done]
    heard = [v for v in rms if v > 1e-5]
    if len(heard) > 1:
        gains = [min(2, max(0.5, np.median(heard) / v)) if v >= 1e-5 else 1 for v in rms]
        done = [[v * g for v in x] if abs(g - 1) >= 0.02 else x for x, g in zip(done, gains)]
    fade = min(math.floor(0.006 * sr + 0.5), *(len(x) // 2 for x in done))
    starts, at = [], 0
    for i, x in enumerate(done):
        done[i] = x = list(x)
        for k in range(fade):
            if i:
                x[k] *= k / fade
            if i < len(done) - 1:
                x[len(x) - fade + k] *= 1 - k / fade
        starts.append(at)
        at += len(x) + math.floor(0.15 * sr + 0.5)
    top = max((abs(v) for x in done for v in x), default=0)
    return [[v * 0.99 / top for v in x] if top > 0.99 else x for x in done], starts


def test_segments_of_a_passage(spark):
    rng = np.random.default_rng(4)
    noisy = lambda v, n: np.concatenate([np.zeros(int(rng.integers(0, 900))), v * rng.normal(size=n), np.zeros(int(rng.integers(0, 700)))]).tolist()
    spiky = (np.concatenate([rng.normal(size=3000) * 0.3, np.where(np.arange(2000) % 79 == 0, 0.2, 0.0), np.zeros(900)])).tolist()
    passages = {
        1: ([noisy(0.01, 1500), noisy(0.4, 2100), noisy(0.9, 1700), noisy(0.2, 2000), noisy(1e-7, 900)], 16000),
        2: ([spiky], 16000), 3: ([noisy(0.9, 2000), spiky], 22050), 4: ([[0.0] * 2000, noisy(0.3, 2000)], 22050),
        5: ([noisy(0.5, 40), [0.3] * 31, [], [0.7]], 24000), 6: ([noisy(2.0, 3000)], 16000), 7: ([noisy(0.3, 1999), noisy(0.31, 1801)], 11025), 8: ([[0.0] * 10, [1e-6] * 500], 8000),
    }
    rows = [(p, i, x, sr) for p, (parts, sr) in passages.items() for i, x in enumerate(parts)] + [(9, 0, spiky, 16000), (9, 1, spiky, 8000)]
    df = spark.createDataFrame(rows, "p int, i int, x array<double>, sr int").repartition(3)
    got = {(r["p"], r["i"]): r for r in signal.join_segments(df, "p", "i", "x", "sr", block=2).collect()}
    assert len(got) == len(rows)
    for p, (parts, sr) in passages.items():
        for i, (x, start) in enumerate(zip(*plain_join(parts, sr))):
            r = got[p, i]
            assert r["start"] == start and len(r["samples"]) == len(x) and np.allclose(r["samples"], x, atol=1e-12), (p, i)
    assert got[9, 0]["samples"] is None and got[9, 1]["start"] is None


def test_running_total_over_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), i, int(rng.integers(0, 9))) for g in (1, 2) for i in rng.choice(500, 60, replace=False).tolist()]
    got = {(r["g"], r["i"]): r["t"] for r in signal.running_total(spark.createDataFrame(rows, "g int, i int, v int"), "g", "i", F.col("v"), "t", 7).collect()}
    assert got == {(g, i): sum(v for h, j, v in rows if h == g and j < i) for g, i, _ in rows}


def test_spectrum_of_band_limited_noise():
    rng = np.random.default_rng(3)
    noise = np.fft.rfft(rng.normal(size=24000))
    noise[4000:] = 0
    e8k, f999 = signal.spectrum(np.fft.irfft(noise), 24000)
    assert e8k < 1e-6 and 3900 < f999 < 4100
    assert signal.spectrum(np.zeros(5000), 24000) == (0.0, 0.0) and signal.spectrum(rng.normal(size=100), 24000) == (0.0, 0.0)
    x = np.concatenate([np.zeros(4000), rng.normal(size=8000), np.zeros(4000)])
    lo, hi = signal.trim_bounds(x, 16000)
    assert 3600 <= lo <= 4000 and 12000 <= hi <= 12400 and signal.signal_noise(x, 16000) > 100 and signal.signal_noise(x[:500], 16000) == 0


def plain_split(groups, val, test, seed=1804):
    import hashlib

    total = sum(groups.values())
    have, out = {"test": 0.0, "val": 0.0}, {}
    for g in sorted(groups, key=lambda g: hashlib.md5(f"{seed}|{g}".encode()).hexdigest()):
        name = next((n for n, share in (("test", test), ("val", val)) if have[n] < share * total and have[n] + groups[g] <= 1.15 * share * total), "train")
        have[name] = have.get(name, 0.0) + groups[g]
        out[g] = name
    return out


@pytest.mark.parametrize(("n", "skew"), [(12, 1), (400, 1), (400, 3), (6000, 2), (1, 1)])
def test_group_split_equals_one_after_the_other(spark, n, skew):
    rng = np.random.default_rng(n + skew)
    groups = {f"g{i}": float(int(1 + 100 * rng.random() ** skew * (50 if i % 97 == 0 else 1))) for i in range(n)}
    df = spark.createDataFrame(list(groups.items()), "g string, d double")
    got = {r["g"]: r["split"] for r in splits.group_split(df, "g", "d", 0.1, 0.05).collect()}
    assert got == plain_split(groups, 0.1, 0.05)


def test_voices_match_in_any_case_of_the_clip(spark):
    clips = spark.createDataFrame([("LEO",), ("leo",), ("Leo",), ("job",), (None,), ("x",)], "speaker string")
    voices = spark.createDataFrame([("a", "Leo", True, []), ("b", "job", True, [])], "name string, speaker_id string, stage2 boolean, stage2_sources array<string>")
    got = sorted(((r["speaker"], r["voice"]) for r in profile.with_voice(clips, voices).collect()), key=str)
    assert got == sorted([("LEO", "a"), ("leo", "a"), ("Leo", "a"), ("job", "b"), (None, None), ("x", None)], key=str)
    order = profile.report_order(spark.createDataFrame([(None, "a"), ("v", "z"), ("w", "b")], "voice string, speaker string"), "voice", "speaker")
    assert [r["speaker"] for r in order.collect()] == ["b", "z", "a"]


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    rng = np.random.default_rng(6)
    pairs = [[rng.integers(0, k, rng.integers(0, 90)) for _ in range(2)] for k in (1, 4, 300, 70_000) for _ in range(60)]
    for _ in range(200):  # near ones: words lost, changed and put in
        a = rng.integers(0, rng.choice([3, 500]), rng.integers(0, 200))
        b = a[rng.random(len(a)) > rng.choice([0, 0.05, 0.4])].copy()
        b[rng.random(len(b)) < rng.choice([0, 0.1])] = 1
        pairs.append([a, np.insert(b, rng.integers(0, len(b) + 1), rng.integers(0, 9, rng.choice([0, 0, 2])))])
    first, second = ([p[i].astype(np.uint32) for p in pairs] for i in range(2))
    want = [plain_distance(a.tolist(), b.tolist()) for a, b in pairs]
    assert edits.distances(first, second).tolist() == edits.distances(second, first).tolist() == want
    assert [edits.bit_distance(a.tolist(), b.tolist()) for a, b in pairs] == want
    many = np.arange(40_000)
    assert edits.distances([many, many[:0]], [np.append(many[1:], 7), many[:5]]).tolist() == [2, 5]


@pytest.mark.parametrize("costs", [{"CELL_S": 0, "STEP_S": 0}, {"CELL_S": 1}])
def test_both_ways_of_edit_distance(monkeypatch, costs):
    for name, value in costs.items():
        monkeypatch.setattr(edits, name, value)
    monkeypatch.setattr(edits, "SYMBOLS", 500)
    test_edit_distance()


def test_error_rates_of_whole_documents(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["le", "Chèvre", "de", "e,", "x" * 5, "d'eau"], int(n))) for n in rng.integers(1, 120, 30)]
    spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["model"], r["latency_ms"]): (r["wer"], r["cer"], r["clips"]) for r in catalog.document_error_rates(spark, str(tmp_path)).collect()}
    form = lambda t: " ".join("".join(c for c in t.lower() if c not in ",'").split())
    for model, k in (("baseline", 3), ("tuned", 7)):
        pairs = []
        for t in texts:
            kept = [w for i, w in enumerate(t.split(), 1) if i % k]
            heard = " ".join(w.replace("e", "a") if i % 5 == 0 else w for i, w in enumerate(kept, 1))
            pairs.append((form(t), form(heard)))
        wer = sum(plain_distance(r.split(), h.split()) for r, h in pairs) / sum(len(r.split()) for r, _ in pairs)
        cer = sum(plain_distance(r, h) for r, h in pairs) / sum(len(r) for r, _ in pairs)
        for latency in (80, 320):
            w, c, n = got[model, latency]
            assert n == 30 and abs(w - wer) < 1e-5 and abs(c - cer) < 1e-5


def test_length_table_of_real_lengths(spark):
    rng = np.random.default_rng(9)
    data = [(i, float(np.round(rng.exponential(40), 2)), rng.normal(size=3).tolist()) for i in range(150)]
    got = {(r["target"], r["dim"]): r["value"] for r in vectors.length_table(spark.createDataFrame(data, "id long, length double, vec array<double>"), 200).collect()}
    for t in range(1, 201):
        near = [v for _, n, v in data if abs(n - t) <= max(3, 0.2 * t)]
        if len(near) < 5:
            near = [v for _, _, v in sorted(data, key=lambda r: (abs(r[1] - t), r[0]))[:5]]
        assert math.isclose(got[t, 1], np.mean([v[1] for v in near]), abs_tol=1e-9), t


def test_token_pieces_and_phoneme_verdicts(spark):
    vocabulary = spark.createDataFrame([("wi", 1), ("andu", 2), ("w", 3)], "piece string, id int")
    df = spark.createDataFrame([("wi ñandu 漢",), ("wi",)], "text string").withColumn("tokens", tokenizer(vocabulary)(F.col("text")))
    assert [(r["piece"], r["n"]) for r in coverage.unknown_pieces(df, "text", "tokens", 0).collect()] == [("ñ", 1), ("漢", 1)]
    report = coverage.token_report(df, "text", "tokens", 0).first()
    assert (report["tokens"], report["unknown"], report["words"], report["verdict"]) == (5, 2, 4, "REVIEW")
    said = coverage.phoneme_report(spark.createDataFrame([("ab #",)], "said string"), "said")
    assert coverage.phoneme_verdict(said).first()["verdict"] == "FAIL"
    assert [r["phoneme"] for r in coverage.unknown_phonemes(said).collect()] == ["#"]
    assert [r["phoneme"] for r in coverage.rare_phonemes(said).collect()] == ["a", "b"]


def test_stage_and_style_rules(spark):
    df = spark.createDataFrame([("A", 0.5, 0.1), ("D", 0.2, 0.3), ("X", 0.1, 0.9)], "t string, a double, b double")
    got = df.select(profile.first_stage(F.col("t"), ("A",)), profile.style_verdict(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(True, "MISMATCH"), (True, "OK"), (False, "MISMATCH")]


def test_phoneme_report(spark):
    df = spark.createDataFrame([("ab ɡ#",), ("a.",)], "said string")
    got = {r["phoneme"]: (r["n"], r["known"]) for r in coverage.phoneme_report(df, "said").collect()}
    assert got == {"a": (2, True), "b": (1, True), "ɡ": (1, True), "#": (1, False), ".": (1, True)}


def test_wav_bytes_and_broken_ones(spark):
    x = np.array([0.5, -0.25, 1.0, -1.0])
    whole = signal.encode_wav([x, x / 2], 8000, extra=b"odd")
    rows = [(1, whole), (2, whole[:-3]), (3, whole[:30]), (4, b""), (5, None), (6, signal.encode_wav([x], 16000, floats=True)), (7, b"RIFF" + b"\0" * 60), (8, whole[:12] + b"fmt " + struct.pack("<I", 16) + b"\0" * 3)]
    got = {r["i"]: r for r in signal.decode(spark.createDataFrame(rows, "i int, audio binary"), "i", "audio").collect()}
    assert np.allclose(got[1]["samples"], x * 0.75, atol=1e-4) and got[1]["native_sr"] == 8000 and len(got[2]["samples"]) == 3
    assert got[6]["samples"] == x.tolist() and [got[i]["samples"] for i in (3, 4, 5, 7, 8)] == [None] * 5


@pytest.mark.parametrize("seed", range(6))
def test_group_split_like_one_by_one(spark, seed):
    rng = np.random.default_rng(seed)
    hours = rng.integers(0, 20, 150).tolist() + (rng.integers(15, 400, int(rng.integers(1, 30))) * [1, 3, 1, 8, 1, 2][seed]).tolist()
    names = [f"g{i}" for i in range(len(hours))]
    val, test = [(0.1, 0.1), (0.2, 0.05), (0.1, 0.1), (0.3, 0.3), (0.0, 0.1), (0.1, 0.0)][seed]
    total = sum(hours)
    have, want = {"test": 0, "val": 0}, {}
    goal = {"test": test * total, "val": val * total}
    for g, d in sorted(zip(names, hours), key=lambda x: hashlib.md5(f"1804|{x[0]}".encode()).hexdigest()):
        want[g] = next((s for s in ("test", "val") if have[s] < goal[s] and have[s] + d <= 1.15 * goal[s]), "train")
        if want[g] != "train":
            have[want[g]] += d
    df = spark.createDataFrame([(g, float(d)) for g, d in zip(names, hours)], "g string, d double")
    assert {r["g"]: r["split"] for r in splits.group_split(df, "g", "d", val, test).collect()} == want
