"""One query per operator on the given tables.

Signals: EVT is ``events.value`` per user in time order, LIN is ``lineitem.l_extendedprice`` per
supplier in shipping order scaled to [0, 1), EMB is ``embeddings.embedding``.
"""

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.functions import levels, spectral
from sonomere.functions.bands import Bands, range_error
from sonomere.functions.frequency import Interleaved, Spectrum
from sonomere.functions.literals import elements
from sonomere.functions.spectral import Windowing
from sonomere.functions.tapers import Taper, blackman, hamming, hann
from sonomere.operators import aggregates, compare, frames, shape, windows
from sonomere.plans.recordings import damage_recordings, write_recordings
from sonomere.plans.workflows import AllFeatures, Tol, WelchSpl, WelchSplTol, calibrate_records
from sonomere.sources import grid, series, vectors, wav, wav_format
from sonomere.sources.pcm import decode_pcm
from sonomere.storage import new_path
from sonomere.streaming.records import stream_records, write_features, write_stream

Query = Callable[[SparkSession, str], DataFrame]

FULL_SCALE = 131072.0
FS = 64.0
LOW, HIGH = 6.4, 25.6
ALPHA = 1.75
RECORDERS = 4
FILE_FRAMES = 900 * int(FS)
DAY_FRAMES = 86_400 * int(FS)
TAPERS = {"hamming": hamming, "hann": hann, "blackman": blackman}
KINDS = ("periodic", "symmetric")
LIN_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
RECORD = ["l_suppkey", "record_idx"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# Signals


def evt(spark, sf, bucket="day"):
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return frames.number_frames(
        rows, ["user_id"], ["ts", "event_id"], bucket=F.date_trunc(bucket, "ts")
    )


def lin(spark, sf, bucket="year"):
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", *LIN_ORDER, (F.col("l_extendedprice") / FULL_SCALE).alias("x")
    )
    time = F.date_trunc(bucket, "l_shipdate") if bucket else None
    return frames.number_frames(rows, ["l_suppkey"], LIN_ORDER, bucket=time)


def lin_records(spark, sf, policy="fill"):
    records = frames.cut_records(lin(spark, sf), ["l_suppkey"], 128, {"samples": "x"}, policy)
    return records.withColumn("timestamp", F.timestamp_seconds(F.col("record_idx") * 2))


def emb(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("samples")
    )


def boxcar(size):
    return Taper.of(np.ones(size))


# Sources


def numbered(bucket):
    """Numbered frames, in buckets of time or in ranges of rows."""
    def query(spark, sf):
        rows = lin(spark, sf, bucket)
        return rows.select("l_suppkey", "frame", F.round("l_extendedprice", 2).alias("v"))

    return query


def _recordings(spark, sf, bits, frames_per_file=FILE_FRAMES):
    """Recordings of four recorders that share the rows of LIN: two 16-bit channels, or one of 8
    or 24 bits, a quarter of an hour per file unless told otherwise.
    """
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    samples = {
        8: [F.floor(quantity * 4)],
        16: [F.floor(price / 4), F.floor(quantity * 100)],
        24: [F.floor(price * 64)],
    }[bits]
    rows = table(spark, sf, "lineitem").withColumn("recorder", F.col("l_suppkey") % RECORDERS)
    rows = frames.number_frames(
        rows.select("recorder", "l_suppkey", "l_quantity", *LIN_ORDER), ["recorder"],
        [*LIN_ORDER, "l_suppkey"], bucket=F.date_trunc("month", "l_shipdate"),
    )
    folder, made = write_recordings(rows, "recorder", samples, int(FS), bits, frames_per_file)
    return folder, made, len(samples)


def _wav_rows(records):
    per_channel = shape.explode_channels(records)
    return per_channel.select(
        "sound_id", "record_idx", "channel",
        F.unix_millis("timestamp").alias("ms"),
        F.posexplode(elements("samples")).alias("i", "v"),
    ).withColumn("v", F.round("v", 9))


def wav_records(bits, policy, split_bytes=wav.SPLIT_BYTES):
    """Records of all files; a small ``split_bytes`` has every file read by many tasks."""
    def query(spark, sf):
        folder, made, channels = _recordings(spark, sf, bits)
        return _wav_rows(
            wav.read_wav_records(
                spark, folder, made.select("name", "start"), FS, channels, bits, 2.0, policy,
                split_bytes=split_bytes,
            )
        )

    return query


def wav_file(spark, sf):
    """Every file by its own name, each a whole day of a recorder."""
    folder, made, channels = _recordings(spark, sf, 16, DAY_FRAMES)
    # A name per day and recorder.
    names = sorted((r["name"], r["start"]) for r in made.select("name", "start").collect())
    records = [
        wav.read_wav_file(spark, f"{folder}/{name}", start, FS, channels, 16, 2.0, "fill")
        for name, start in names
    ]
    return _wav_rows(reduce(DataFrame.union, records))


def wav_format_records(streamed):
    """The recordings through the data source: as a table from the fourth record of each on, which
    leaves the ones before unread, or as files that arrive.
    """
    def query(spark, sf):
        folder, _, channels = _recordings(spark, sf, 16)
        wav_format.register(spark)
        reader = (spark.readStream if streamed else spark.read).format("wav").options(
            recordSeconds=2.0, fs=FS, channels=channels, bits=16, lastRecord="fill"
        )
        records = reader.load(folder)
        if streamed:
            target = new_path(spark, "stream-out")
            write_stream(records, target, new_path(spark, "stream-state")).awaitTermination()
            return _wav_rows(spark.read.parquet(target))
        return _wav_rows(records.filter("record_idx >= 3"))

    return query


def wav_by_path(spark, sf):
    """Every file through a glob that names it, the catalogue given as paths."""
    folder, made, channels = _recordings(spark, sf, 16)
    starts = made.select(F.concat(F.lit(folder + "/"), F.col("name")).alias("name"), "start")
    return _wav_rows(
        wav.read_wav_records(
            spark, folder + "/*.wav", starts, FS, channels, 16, 1.0, "fill"
        )
    )


def wav_chunks(spark, sf):
    folder, _, _ = _recordings(spark, sf, 16)
    # Files shorter than the offset would fail, so the offset is below the shortest.
    return _wav_rows(wav.read_wav_chunks(spark, folder, 50, offset_frame=7, max_chunks=3))


def wav_inspect(spark, sf):
    folder, _, _ = _recordings(spark, sf, 24)
    return wav.inspect_wavs(spark, folder).select(
        F.element_at(F.split("path", "/"), -1).alias("sound_id"),
        "ok", "fs", "channels", "bits", "frames",
    )


def wav_damaged(spark, sf):
    """Audit of whole and damaged copies of the recordings."""
    folder, made, _ = _recordings(spark, sf, 16)
    return wav.inspect_wavs(spark, damage_recordings(spark, folder, made)).select(
        F.element_at(F.split("path", "/"), -1).alias("sound_id"),
        "ok", "error", "fs", "channels", "bits", "frames",
    )


def wav_declarations(spark, sf):
    """What readers told a wrong format say of the recordings and their damaged copies."""
    folder, made, _ = _recordings(spark, sf, 16)
    damaged = damage_recordings(spark, folder, made)
    audit = wav.inspect_wavs(spark, damaged).withColumn("path", F.element_at(F.split("path", "/"), -1))
    out = None
    for declared in ((FS, 2, 16), (48.0, 2, 16), (FS, 1, 16), (FS, 2, 24)):
        rows = wav.declaration_errors(audit, *declared).select(
            F.lit(" ".join(map(str, declared))).alias("declared"), F.col("path").alias("sound_id"), "error"
        )
        out = rows if out is None else out.union(rows)
    return out


def wav_duplicate_names(spark, sf):
    """File names that a list of start dates, made from all line items, has more than once."""
    name = F.concat(F.col("l_suppkey").cast("string"), F.lit("_"), F.year("l_shipdate"), F.lit(".wav"))
    return wav.duplicate_names(table(spark, sf, "lineitem").select(name.alias("name")))


def _channel_rows(features):
    """Long form of WF-3's features of multi-channel records."""
    per_channel = F.explode(
        F.transform(
            F.arrays_zip("welch", "spl", "tol"),
            lambda c, i: F.struct(
                i.alias("channel"), c["welch"].alias("welch"), c["spl"][0].alias("spl"),
                c["tol"].alias("tol"),
            ),
        )
    )
    rows = features.select("sound_id", "record_idx", per_channel.alias("c"))
    return _feature_rows(
        rows.select("sound_id", "record_idx", "c.channel", "c.welch", "c.spl", "c.tol"),
        ["sound_id", "record_idx", "channel"],
    )


def wav_features(spark, sf):
    """WF-3 straight from files: calibrated Welch, SPL and TOL of both channels of every record."""
    folder, made, channels = _recordings(spark, sf, 16)
    features = WelchSplTol(2.0, 32, 16, 32, LOW, HIGH).of_recordings(
        spark, folder, made.select("name", "start"), FS, channels, 16, "fill", calibration=-2.0
    )
    return _channel_rows(features)


def wav_records_features(spark, sf):
    """The same step by step: read records, calibrate them, compute features."""
    folder, made, channels = _recordings(spark, sf, 16)
    records = wav.read_wav_records(
        spark, folder, made.select("name", "start"), FS, channels, 16, 2.0, "fill"
    )
    return _channel_rows(
        WelchSplTol(2.0, 32, 16, 32, LOW, HIGH)(calibrate_records(records, -2.0), FS)
    )


def decode_blobs(spark, sf):
    """SRC-8 on bytes held in a table: the UTF-8 bytes of the page URLs read as 8-bit mono PCM."""
    pages = table(spark, sf, "pages").select("page_id", F.encode("url", "UTF-8").alias("raw"))
    samples = pages.select("page_id", decode_pcm(F.col("raw"), 8, 1).alias("channels"))
    per_channel = shape.explode_channels(samples)
    rows = windows.bins(per_channel, ["page_id", "channel"], "samples", "v", "i")
    return rounded(rows, "v", digits=9)


def decode_html(bits, channels):
    """The bytes of the pages themselves as PCM of that form, without what is left over."""
    def query(spark, sf):
        raw = F.encode("html", "UTF-8")
        frame = bits // 8 * channels
        whole = F.octet_length(raw) - F.octet_length(raw) % frame
        pages = table(spark, sf, "pages").select("page_id", F.substring(raw, F.lit(1), whole).alias("raw"))
        samples = pages.select("page_id", decode_pcm(F.col("raw"), bits, channels).alias("channels"))
        rows = windows.bins(shape.explode_channels(samples), ["page_id", "channel"], "samples", "v", "i")
        return rounded(rows, "v", digits=9)

    return query


def timeserie(tick, blocks):
    def query(spark, sf):
        """As many ticks as there are events, from the first event on, with the events in each."""
        shown = "yyyy-MM-dd HH:mm:ss"
        events = table(spark, sf, "events").select("ts", "value")
        span = events.agg(
            F.date_format(F.min("ts"), shown).alias("start"), F.count("*").alias("n")
        ).first()
        start, step = datetime.fromisoformat(span["start"]), timedelta(seconds=tick)
        made = series.make_timeserie(spark, start, start + step * span["n"], step, num_blocks=blocks)
        origin = F.unix_seconds(F.lit(start).cast("timestamp"))
        since = F.unix_seconds(F.col("ts").cast("timestamp")) - origin
        held = events.groupBy((F.floor(since / tick) * tick + origin).alias("__second")).agg(
            F.count("*").alias("n_events"), F.sum("value").alias("total")
        )
        rows = made.withColumn("__second", F.unix_seconds("ts")).join(held, "__second", "left")
        rows = rows.select(
            F.date_format("ts", shown).alias("ts"), "val",
            F.coalesce("n_events", F.lit(0)).alias("n_events"), "total",
        )
        return rounded(rows, "total")

    return query


def vector_files(spark, sf):
    """Embeddings written as text, one vector per line after its key, and read back."""
    path = new_path(spark, "vectors")
    line = F.concat_ws(" ", F.col("vec_id").cast("string"), F.array_join("samples", " "))
    emb(spark, sf).select(line.alias("value")).write.text(path)
    rows = vectors.read_vectors(spark, path).select(
        F.element_at("values", 1).cast("bigint").alias("vec_id"),
        F.posexplode(F.slice("values", F.lit(2), F.size("values") - 1)).alias("i", "v"),
    )
    return rounded(rows, "v")


def sound_names(spark, sf):
    """File names composed from the suppliers' signals, and the parameters parsed from them."""
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    sound = vectors.sound_name(
        F.concat(F.lit("S"), F.col("l_suppkey")), F.lit(64), F.lit(24), F.col("n"), F.lit(FS),
        F.lit(1),
    )
    name = vectors.result_name(
        sound, F.lit("vPSD"), F.lit(32), F.lit(32), F.lit(16), F.lit(64)
    )
    return counts.select(name.alias("file_name")).select(
        "file_name", vectors.parse_result_name(F.col("file_name")).alias("p")
    ).select("file_name", "p.*")


def grid_to_rows(spark, sf):
    """Embeddings as 8 x 8 slices, with coordinates of both dimensions."""
    slices = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8)
    )
    cells = grid.grid_to_rows(
        table(spark, sf, "embeddings").select("vec_id", slices.alias("g")), ["vec_id"], "g"
    )
    axis = spark.range(8)
    lat = axis.select("id", (F.col("id") + 1.0).alias("lat"))
    lon = axis.select("id", (F.col("id") - 10.0).alias("lon"))
    cells = grid.with_coordinates(cells, lat, "i", "lat")
    cells = grid.with_coordinates(cells, lon, "j", "lon")
    return cells.select("vec_id", "lat", "lon", F.round(F.col("value").cast("double"), 6).alias("v"))


# Projections


def calibrate_signal(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber",
        levels.calibrate_value(F.col("l_extendedprice"), -2.0).alias("v"),
    )
    return rounded(rows, "v", digits=4)


def calibrate_arrays(spark, sf):
    rows = emb(spark, sf).select(
        "vec_id", F.posexplode(levels.calibrate(F.col("samples"), -20.5)).alias("i", "v")
    )
    return rounded(rows, "v")


def decibels(spark, sf):
    """Tax rates in dB; the zero rate is at -Infinity, shown as NULL with a flag."""
    db = levels.to_db(F.col("l_tax"))
    floor = F.lit(float("-inf"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        (db == floor).alias("silent"),
        F.round(F.when(db != floor, db), 6).alias("db"),
    )


# Segmentation


def segment_events(spark, sf):
    blocks = frames.cut_blocks(evt(spark, sf), ["user_id"], "value", 10, 8, windows_per_block=16)
    cut = windows.segment(blocks, 10, 8)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return rounded(
        cut.select(
            "user_id",
            (F.col("first_window") + F.col("window_idx")).alias("window_idx"),
            F.col("x")[0].alias("x_first"),
            F.col("x")[9].alias("x_last"),
            total.alias("x_sum"),
        ),
        "x_sum",
    )


def segment_counts(spark, sf):
    blocks = frames.cut_blocks(evt(spark, sf), ["user_id"], "value", 10, 8)
    counted = blocks.select("user_id", (F.floor((F.size("samples") - 10) / 2) + 1).alias("n"))
    return counted.groupBy("user_id").agg(F.sum("n").alias("n_windows"))


def segment_tol(spark, sf):
    cut = windows.segment_tol(lin_records(spark, sf), FS)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return rounded(cut.select(*RECORD, "window_idx", total.alias("x_sum")), "x_sum")


def records(policy):
    def query(spark, sf):
        cut = lin_records(spark, sf, policy)
        total = F.aggregate("samples", F.lit(0.0), lambda a, v: a + v)
        return rounded(
            cut.select(
                *RECORD, F.size("samples").alias("n"), total.alias("total"),
                F.col("samples")[0].alias("first"),
            ),
            "total", "first",
        )

    return query


# Tapers


def window_coefficients(spark, sf):
    """Every taper of both kinds on every vector, from one scan."""
    every = [
        F.struct(
            F.lit(name).alias("taper"), F.lit(kind).alias("kind"),
            make(64, kind).apply(F.col("samples")).alias("tapered"),
        )
        for name, make in TAPERS.items() for kind in KINDS
    ]
    rows = emb(spark, sf).select("vec_id", F.explode(F.array(*every)).alias("t"))
    rows = rows.select("t.taper", "t.kind", "vec_id", F.posexplode("t.tapered").alias("i", "v"))
    return rounded(rows, "v", digits=9)


def tapered_long(spark, sf):
    """A user-defined window (1, 2, ..., 64) on vectors in long form."""
    rows = emb(spark, sf).select("vec_id", F.posexplode("samples").alias("i", "value"))
    ramp = Taper.of(np.arange(1, 65))
    out = windows.apply_taper_long(rows, ramp).select("vec_id", "i", F.col("value").alias("v"))
    return rounded(out, "v")


def window_norm_factors(spark, sf):
    """Energy and squared sum of tapered vectors over the density and spectrum factors."""
    every = []
    for name, make in TAPERS.items():
        for kind in KINDS:
            taper = make(64, kind)
            tapered = taper.apply(F.col("samples"))
            squares = F.aggregate(tapered, F.lit(0.0), lambda a, v: a + v * v)
            total = F.aggregate(tapered, F.lit(0.0), lambda a, v: a + v)
            every.append(F.struct(
                F.lit(name).alias("taper"), F.lit(kind).alias("kind"),
                (squares / F.lit(taper.density_factor(ALPHA))).alias("density"),
                (total * total / F.lit(taper.spectrum_factor(ALPHA))).alias("spectrum"),
            ))
    rows = emb(spark, sf).select("vec_id", F.explode(F.array(*every)).alias("t"))
    return rounded(rows.select("vec_id", "t.*"), "density", "spectrum")


# Spectra


def fft_embeddings(nfft):
    def query(spark, sf):
        spectra = emb(spark, sf).select(
            "vec_id", spectral.fft(F.col("samples"), nfft).alias("fft")
        )
        return rounded(windows.complex_bins(spectra, ["vec_id"]), "re", "im")

    return query


def stft_embeddings(spark, sf):
    spectra = windows.stft(emb(spark, sf), Windowing(32, 16, 32, FS))
    return rounded(windows.complex_bins(spectra, ["vec_id", "window_idx"]), "re", "im")


def stft_spectrum_norm(spark, sf):
    spectra = windows.stft(emb(spark, sf), Windowing(32, 16, 32, FS))
    normed = spectra.withColumn("fft", spectral.normalized_fft(F.col("fft"), hamming(32)))
    return rounded(windows.complex_bins(normed, ["vec_id", "window_idx"]), "re", "im", digits=9)


def fft_two_sided(spark, sf):
    spectra = emb(spark, sf).withColumn("fft", spectral.fft(F.col("samples"), 64))
    both = spectra.select("vec_id", spectral.two_sided(F.col("fft"), 64).alias("fft"))
    return rounded(windows.complex_bins(both, ["vec_id"]), "re", "im")


def periodogram_embeddings(nfft):
    def query(spark, sf):
        spectra = emb(spark, sf).withColumn("fft", spectral.fft(F.col("samples"), nfft))
        psd = spectra.select(
            "vec_id", spectral.periodogram(F.col("fft"), nfft, 1.0 / nfft).alias("psd")
        )
        return rounded(windows.bins(psd, ["vec_id"]), "p")

    return query


def power_spectrum(make, kind):
    def query(spark, sf):
        taper = make(64, kind)
        spectra = windows.spectrogram(
            emb(spark, sf), Windowing(64, 0, 64, FS, taper, taper.spectrum_norm())
        )
        return rounded(windows.bins(spectra, ["vec_id"]), "p", digits=9)

    return query


def spectrogram_lineitem(spark, sf):
    spectra = windows.spectrogram(lin_records(spark, sf), Windowing(32, 16, 32, FS))
    return rounded(windows.bins(spectra, [*RECORD, "window_idx"]), "p", digits=9)


def welch_psd_events(spark, sf):
    """Welch power spectral density of every user's signal, however long."""
    windowing = Windowing(32, 16, 32, 32.0)
    blocks = frames.cut_blocks(evt(spark, sf), ["user_id"], "value", 32, 16)
    means = blocks.select(
        "user_id",
        (F.floor((F.size("samples") - 32) / 16) + 1).alias("n"),
        spectral.welch(F.col("samples"), windowing).alias("psd"),
    )
    density = aggregates.welch_long(means, ["user_id"], 32, weight=F.col("n"))
    return rounded(density, "p")


def welch_from_windows(spark, sf):
    """The same estimate window by window: segment, taper, FFT, periodogram, mean."""
    taper = hamming(32)
    signal = evt(spark, sf, bucket="hour")
    blocks = frames.cut_blocks(signal, ["user_id"], "value", 32, 16, windows_per_block=2)
    cut = windows.apply_taper(windows.segment(blocks, 32, 16), taper)
    spectra = cut.withColumn("fft", spectral.fft(F.col("x"), 32))
    psd = spectra.withColumn(
        "psd", spectral.periodogram(F.col("fft"), 32, taper.density_norm(32.0))
    )
    return rounded(aggregates.welch_long(psd, ["user_id"], 32), "p")


def welch_in_row(spark, sf):
    """Welch aggregation of periodograms nested in one row per vector."""
    nested = emb(spark, sf).withColumn(
        "psds", spectral.spectrogram(F.col("samples"), Windowing(32, 16, 32, FS))
    )
    means = nested.select("vec_id", spectral.vector_mean(F.col("psds"), 32).alias("psd"))
    return rounded(windows.bins(means, ["vec_id"]), "p", digits=9)


# Frequencies


def _order_frequencies(spark, sf, low, span):
    return table(spark, sf, "orders").select(
        "o_orderkey", (F.lit(low) + F.col("o_totalprice") % span).alias("freq")
    )


def freq_to_index(spark, sf):
    rows = _order_frequencies(spark, sf, 0.0, 32.0)
    return rows.select(
        "o_orderkey",
        Spectrum(64, FS).frequency_to_index(F.col("freq")).alias("idx"),
        Interleaved(64, FS).frequency_to_index(F.col("freq")).alias("fft_idx"),
        Spectrum(100, FS).frequency_to_index(F.col("freq")).alias("idx_100"),
    )


def index_to_freq(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 51).alias("idx"))
    out = rows.select(
        "o_orderkey",
        Spectrum(100, 44800.0).index_to_frequency(F.col("idx")).alias("freq"),
        Interleaved(100, 44800.0).index_to_frequency(F.col("idx")).alias("fft_freq"),
    )
    return rounded(out, "freq", "fft_freq")


def freq_vector(spark, sf):
    """Power spectra with their frequency axis."""
    psd = windows.spectrogram(emb(spark, sf), Windowing(64, 0, 65, FS))
    axis = Spectrum(65, FS).frequency_vector()
    rows = psd.select("vec_id", F.posexplode(F.arrays_zip(axis.alias("freq"), "psd")))
    out = rows.select(
        "vec_id", F.col("pos").alias("k"), F.col("col")["freq"].alias("freq"),
        F.col("col")["psd"].alias("p"),
    )
    return rounded(out, "freq", "p", digits=9)


def fft_freq_vector(spark, sf):
    """Interleaved spectra with their frequency axis, every frequency twice."""
    spectra = emb(spark, sf).withColumn("fft", spectral.fft(F.col("samples"), 64))
    axis = Interleaved(64, FS).frequency_vector()
    rows = spectra.select("vec_id", F.posexplode(F.arrays_zip(axis.alias("freq"), "fft")))
    out = rows.select(
        "vec_id", F.col("pos").alias("j"), F.col("col")["freq"].alias("freq"),
        F.col("col")["fft"].alias("v"),
    )
    return rounded(out, "freq", "v")


# Energies


def energy(function, source):
    def query(spark, sf):
        rows = emb(spark, sf)
        if source != "samples":
            rows = rows.withColumn("fft", spectral.fft(F.col("samples"), 64))
        if source == "psd":
            rows = rows.withColumn("psd", spectral.periodogram(F.col("fft"), 64, 1.0 / 64))
        return rounded(rows.select("vec_id", function(F.col(source), 64).alias("v")), "v")

    return query


# Third-octave levels


def _bands():
    return Bands(64, FS, LOW, HIGH)


def tol_bands(spark, sf):
    """The bands of the default range, with the orders whose frequency falls in each."""
    bands = Bands(64, FS)
    freq = _order_frequencies(spark, sf, 1.0, 31.0)
    counts = (
        freq.groupBy(bands.frequency_to_index(F.col("freq")).alias("band"))
        .agg(F.count("*").alias("n"))
    )
    # 15 bands: both sides are bounded by the 61 bands there are.
    out = bands.table(spark).join(counts, "band", "left").fillna(0, ["n"])
    return rounded(out, "lo", "hi")


def tol_freq_vector(spark, sf):
    """Record levels with the lower and upper frequency of their band."""
    axis = _bands().frequency_vector()
    features = Tol(2.0, LOW, HIGH)(lin_records(spark, sf), FS)
    rows = windows.bins(features, RECORD, "tol", "tol", "band")
    edges = F.array(*[F.lit(f) for f in axis])
    out = rows.select(
        *RECORD, "band", F.get(edges, F.col("band")).alias("lo"),
        F.get(edges, F.col("band") + 1).alias("hi"), "tol",
    )
    return _shown(out, "lo", "hi", "tol")


def freq_to_band(spark, sf):
    bands = Bands(64, FS)
    rows = _order_frequencies(spark, sf, 1.0, 31.0)
    return rows.select("o_orderkey", bands.frequency_to_index(F.col("freq")).alias("band"))


def band_to_freq(spark, sf):
    bands = Bands(64, FS)
    rows = _order_frequencies(spark, sf, 1.0, 31.0)
    banded = rows.withColumn("band", bands.frequency_to_index(F.col("freq")))
    low = F.when(F.col("band") >= 0, bands.index_to_frequency(F.col("band")))
    return rounded(banded.select("o_orderkey", "band", low.alias("lo")), "lo")


def tol_parameters(spark, sf):
    """Study ranges taken from orders: accepted, or why not."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 80 + 50).cast("int").alias("nfft"),
        F.when(F.col("o_orderkey") % 5 > 0, F.floor(F.col("o_totalprice") % 40).cast("double")).alias("low"),
        F.when(F.col("o_orderkey") % 3 > 0, F.floor(F.col("o_totalprice") % 37).cast("double")).alias("high"),
    )
    error = range_error(F.col("nfft"), F.lit(FS), F.col("low"), F.col("high"))
    return rows.select("o_orderkey", error.isNull().alias("accepted"), error.alias("error"))


def _tol_spectra(spark, sf):
    return windows.spectrogram(lin_records(spark, sf), Windowing(64, 0, 64, FS))


def _shown(rows: DataFrame, *cols: str) -> DataFrame:
    """Levels rounded; -Infinity, the level of silence, as NULL."""
    audible = {c: F.when(F.col(c) > float("-inf"), F.col(c)) for c in cols}
    return rounded(rows.withColumns(audible), *cols)


def tol_per_window(bands):
    """Levels of every window, from bins in rows; a band without a bin is silent."""
    def query(spark, sf):
        keys = [*RECORD, "window_idx"]
        rows = windows.bins(_tol_spectra(spark, sf), keys)
        return _shown(aggregates.tol_long(rows, keys, bands), "tol")

    return query


def tol_per_window_array(bands):
    def query(spark, sf):
        rows = _tol_spectra(spark, sf).select(
            *RECORD, "window_idx", F.posexplode(bands.levels(F.col("psd"))).alias("band", "tol")
        )
        return _shown(rows, "tol")

    return query


def tol_workflow(agg, sort=False):
    def query(spark, sf):
        features = Tol(2.0, LOW, HIGH, agg)(lin_records(spark, sf), FS, sort=sort)
        return _shown(windows.bins(features, RECORD, "tol", "tol", "band"), "tol")

    return query


def record_tol(agg, bands):
    def query(spark, sf):
        keys = [*RECORD, "window_idx"]
        per_window = aggregates.tol_long(
            windows.bins(_tol_spectra(spark, sf), keys), keys, bands
        )
        return _shown(aggregates.record_tol(per_window, RECORD, agg), "tol")

    return query


# Workflows


def _feature_rows(features: DataFrame, keys: list[str]) -> DataFrame:
    """Long form of ``welch``, ``spl`` (a number) and, if there, ``tol``."""
    named = [("welch", F.col("welch")), ("spl", F.array("spl"))]
    if "tol" in features.columns:
        named.append(("tol", F.col("tol")))
    all_features = F.explode(
        F.array(*[F.struct(F.lit(n).alias("feature"), v.alias("values")) for n, v in named])
    )
    rows = features.select(*keys, all_features.alias("f"))
    rows = rows.select(*keys, "f.feature", F.posexplode("f.values").alias("idx", "v"))
    return _shown(rows, "v")


def _flat_spl(features):
    return features.withColumn("spl", F.col("spl")[0])


def welch_spl_workflow(size, overlap, nfft):
    def query(spark, sf):
        features = WelchSpl(2.0, size, overlap, nfft)(lin_records(spark, sf), FS)
        return _feature_rows(_flat_spl(features), RECORD)

    return query


def welch_spl_stream(spark, sf):
    """WF-1 over the same records arriving as a stream of files."""
    source = new_path(spark, "stream-in")
    lin_records(spark, sf).write.parquet(source)
    arriving = stream_records(spark, source, spark.read.parquet(source).schema)
    target = new_path(spark, "stream-out")
    query = write_features(
        arriving, WelchSpl(2.0, 32, 16, 32), FS, target, new_path(spark, "stream-state")
    )
    query.awaitTermination()
    return _feature_rows(_flat_spl(spark.read.parquet(target)), RECORD)


def welch_spl_tol_workflow(spark, sf):
    features = WelchSplTol(2.0, 32, 16, 32, LOW, HIGH)(lin_records(spark, sf), FS)
    return _feature_rows(_flat_spl(features), RECORD)


def shape_features(spark, sf):
    """Two channels per record, computed one per row and nested into the record's row."""
    two = lin_records(spark, sf).select(
        *RECORD, "timestamp", F.explode(F.array(F.lit(1), F.lit(0))).alias("channel"), "samples"
    )
    scaled = two.withColumn(
        "samples", F.transform("samples", lambda x: x * (F.col("channel") + 1))
    )
    features = _flat_spl(WelchSpl(2.0, 32, 16, 32)(scaled, FS))
    nested = shape.nest_channels(features, [*RECORD, "timestamp"], ["welch", "spl"])
    rows = nested.select(
        *RECORD, F.unix_millis("timestamp").alias("ms"), F.posexplode("spl").alias("channel", "spl")
    )
    return rounded(rows, "spl")


def all_features(spark, sf):
    """Every feature of WF-4 in long form, from one pass over the records."""
    found = AllFeatures(2.0, 32, 16, 32, LOW, HIGH).together(
        lin_records(spark, sf), FS, calibration=-2.0
    )
    return _all_rows(found, RECORD)


def _all_rows(found: DataFrame, keys: list[str]) -> DataFrame:
    def one(name: str, window, values):
        return F.struct(F.lit(name).alias("feature"), window.alias("window_idx"), values.alias("values"))

    def windows_of(name: str):
        return F.transform(name, lambda values, w: one(name, w, values))

    per_window = [windows_of(name) for name in ("fft", "periodogram")]
    whole = F.array(*[one(name, F.lit(-1), F.col(name)) for name in ("welch", "spl", "tol")])
    rows = found.withColumn("__all", F.concat(*per_window, whole))
    rows = rows.select(*keys, F.explode(elements("__all")).alias("f"))
    rows = rows.select("f.feature", *keys, "f.window_idx", F.posexplode("f.values").alias("idx", "v"))
    return _shown(rows, "v")


def all_features_wav(spark, sf):
    """WF-4 of both channels of recordings, from one reading of the files."""
    folder, made, channels = _recordings(spark, sf, 16)
    found = AllFeatures(2.0, 32, 16, 32, LOW, HIGH).together_of_recordings(
        spark, folder, made.select("name", "start"), FS, channels, 16, "fill", calibration=-2.0
    )
    names = ("fft", "periodogram", "welch", "spl", "tol")
    channel = F.posexplode(elements("__channels")).alias("channel", "c")
    zipped = found.withColumn("__channels", F.arrays_zip(*names))
    per_channel = zipped.select("sound_id", "record_idx", channel)
    per_channel = per_channel.select("sound_id", "record_idx", "channel", *[f"c.{n}" for n in names])
    return _all_rows(per_channel, ["sound_id", "record_idx", "channel"])


# Comparisons


def _perturbed(rows):
    return rows.withColumn("samples", F.transform("samples", lambda x: x * 1.01 + 0.001))


def _paired(spark, sf):
    return emb(spark, sf).withColumn("other", F.transform("samples", lambda x: x * 1.01 + 0.001))


def rmse_scalar(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        compare.rmse_values(F.col("l_discount"), F.col("l_tax")).alias("rmse"),
    )
    return rounded(rows, "rmse")


def rmse_vectors(spark, sf):
    rows = _paired(spark, sf).select(
        "vec_id", compare.rmse_vectors(F.col("samples"), F.col("other")).alias("rmse")
    )
    return rounded(rows, "rmse", digits=9)


def rmse_match(spark, sf):
    return _paired(spark, sf).select(
        "vec_id", compare.rmse_match(F.col("samples"), F.col("other"), 0.0103).alias("matched")
    )


def rmse_tables(spark, sf):
    """Two aggregated results: channels of values per record."""
    def result(rows):
        return rows.select("vec_id", F.array("samples").alias("v"))

    expected = emb(spark, sf)
    return rounded(
        compare.rmse_results(result(expected), result(_perturbed(expected)), ["vec_id"], "v"),
        "rmse", digits=9,
    )


def rmse_segmented(spark, sf):
    """Two segmented results: channels of windows of values per record."""
    def result(rows):
        cut = F.transform(
            F.sequence(F.lit(0), F.lit(3)), lambda w: F.slice("samples", w * 16 + 1, 16)
        )
        return rows.select("vec_id", F.array(cut).alias("v"))

    expected = emb(spark, sf)
    return rounded(
        compare.rmse_results(result(expected), result(_perturbed(expected)), ["vec_id"], "v"),
        "rmse", digits=9,
    )


def rmse_long(spark, sf):
    def result(rows):
        return rows.select("vec_id", F.posexplode("samples").alias("k", "v"))

    expected = emb(spark, sf)
    return rounded(
        compare.rmse_long(result(expected), result(_perturbed(expected)), ["vec_id", "k"], "v"),
        "rmse", digits=9,
    )


def paired_run_report(spark, sf):
    runs = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_quantity").alias("a"), F.round(F.col("l_tax") * 500).alias("b")
    )
    report = compare.paired_run_report(runs, "a", "b", ["l_returnflag"])
    doubles = [c for c, t in report.dtypes if t == "double"]
    return rounded(report, *doubles)


QUERIES: dict[str, Query] = {
    "welch_psd_events": welch_psd_events,
    "welch_from_windows": welch_from_windows,
    "welch_in_row": welch_in_row,
    "frames_plain": numbered("year"),
    "frames_by_bucket": numbered("month"),
    "frames_by_range": numbered(None),
    "wav_roundtrip": wav_records(16, "skip"),
    "wav_records_fill": wav_records(16, "fill"),
    "wav_records_8bit": wav_records(8, "keep"),
    "wav_records_24bit": wav_records(24, "fill"),
    "wav_by_path": wav_by_path,
    "wav_file": wav_file,
    "wav_format": wav_format_records(False),
    "wav_format_stream": wav_format_records(True),
    "wav_split_files": wav_records(16, "fill", split_bytes=4096),
    "wav_chunks": wav_chunks,
    "wav_inspect": wav_inspect,
    "wav_damaged": wav_damaged,
    "wav_declarations": wav_declarations,
    "wav_duplicate_names": wav_duplicate_names,
    "wav_features": wav_features,
    "wav_records_features": wav_records_features,
    "decode_pcm": decode_blobs,
    "decode_pcm_16": decode_html(16, 2),
    "decode_pcm_24": decode_html(24, 1),
    "decode_pcm_32": decode_html(32, 2),
    "timeserie": timeserie(1, 1),
    "timeserie_blocks": timeserie(1, 7),
    "timeserie_tick": timeserie(5, 3),
    "vector_files": vector_files,
    "sound_names": sound_names,
    "grid_to_rows": grid_to_rows,
    "calibrate_signal": calibrate_signal,
    "calibrate_arrays": calibrate_arrays,
    "decibels": decibels,
    "segment_events": segment_events,
    "segment_counts": segment_counts,
    "segment_tol": segment_tol,
    "records_skip": records("skip"),
    "records_fill": records("fill"),
    "records_keep": records("keep"),
    "window_coefficients": window_coefficients,
    "tapered_long": tapered_long,
    "window_norm_factors": window_norm_factors,
    "fft_embeddings": fft_embeddings(64),
    "stft_zero_padded": fft_embeddings(128),
    "stft_odd_nfft": fft_embeddings(65),
    "stft_embeddings": stft_embeddings,
    "stft_spectrum_norm": stft_spectrum_norm,
    "fft_two_sided": fft_two_sided,
    "periodogram_even": periodogram_embeddings(64),
    "periodogram_odd": periodogram_embeddings(65),
    "power_spectrum_hann": power_spectrum(hann, "periodic"),
    "power_spectrum_blackman": power_spectrum(blackman, "symmetric"),
    "spectrogram_lineitem": spectrogram_lineitem,
    "freq_to_index": freq_to_index,
    "index_to_freq": index_to_freq,
    "freq_vector": freq_vector,
    "fft_freq_vector": fft_freq_vector,
    "energy_raw": energy(levels.energy_raw, "samples"),
    "energy_fft": energy(levels.energy_fft, "fft"),
    "energy_psd": energy(levels.energy_psd, "psd"),
    "spl_raw": energy(levels.spl_raw, "samples"),
    "spl_fft": energy(levels.spl_fft, "fft"),
    "spl_psd": energy(levels.spl_psd, "psd"),
    "tol_bands": tol_bands,
    "tol_freq_vector": tol_freq_vector,
    "freq_to_band": freq_to_band,
    "band_to_freq": band_to_freq,
    "tol_parameters": tol_parameters,
    "tol_per_window": tol_per_window(Bands(64, FS, LOW, HIGH)),
    "tol_per_window_array": tol_per_window_array(Bands(64, FS, LOW, HIGH)),
    "tol_per_window_default": tol_per_window(Bands(64, FS)),
    "tol_per_window_array_default": tol_per_window_array(Bands(64, FS)),
    "record_tol": record_tol("avg", Bands(64, FS, LOW, HIGH)),
    "record_tol_sum": record_tol("sum", Bands(64, FS, LOW, HIGH)),
    "record_tol_default": record_tol("avg", Bands(64, FS)),
    "tol_workflow": tol_workflow("avg"),
    "tol_workflow_sorted": tol_workflow("avg", sort=True),
    "tol_sum": tol_workflow("sum"),
    "welch_spl_workflow": welch_spl_workflow(32, 16, 32),
    "welch_spl_padded": welch_spl_workflow(24, 12, 29),
    "welch_spl_stream": welch_spl_stream,
    "welch_spl_tol_workflow": welch_spl_tol_workflow,
    "shape_features": shape_features,
    "all_features": all_features,
    "all_features_wav": all_features_wav,
    "rmse_scalar": rmse_scalar,
    "rmse_vectors": rmse_vectors,
    "rmse_match": rmse_match,
    "rmse_tables": rmse_tables,
    "rmse_segmented": rmse_segmented,
    "rmse_long": rmse_long,
    "paired_run_report": paired_run_report,
}
