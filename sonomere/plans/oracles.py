"""The queries of the catalogue as plain SQL, from textbook definitions.

The discrete Fourier transform is written as the sum it is: ``re = sum(x cos(2 pi k i / N))``,
``im = -sum(x sin(2 pi k i / N))``, one group per window and bin.
"""

# Cosine-sum coefficients.
COSINES = {
    "hamming": (0.54, 0.46, 0.0),
    "hann": (0.5, 0.5, 0.0),
    "blackman": (0.42, 0.5, 0.08),
}

LIN_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice"
LIN = f"""lin AS (
  SELECT *, l_extendedprice / 131072::DOUBLE AS x,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY {LIN_ORDER}) - 1 AS frame
  FROM lineitem)"""
REC = LIN + """, rec AS (
  SELECT l_suppkey, frame // 128 AS record_idx, frame % 128 AS j, x FROM lin
  UNION ALL
  SELECT l_suppkey, n // 128, unnest(range(n % 128, 128)), 0::DOUBLE
  FROM (SELECT l_suppkey, count(*) AS n FROM lin GROUP BY l_suppkey) WHERE n % 128 > 0)"""
EVT = """evt AS (
  SELECT user_id, value AS x,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame,
    count(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""
EMB = """emb AS (
  SELECT vec_id, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS x FROM embeddings)"""


def rnd(expression: str, digits: int = 6) -> str:
    """Rounded, with -0.0 turned into 0.0."""
    return f"round({expression}, {digits}) + 0::DOUBLE"


def taper(name: str, size: int, kind: str = "periodic", i: str = "i") -> str:
    a, b, c = COSINES[name]
    period = size if kind == "periodic" else size - 1
    x = f"(-pi() + 2 * pi() * {i} / {period}::DOUBLE)"
    return f"({a}::DOUBLE + {b}::DOUBLE * cos({x}) + {c}::DOUBLE * cos(2 * {x}))"


def factor(what: str, name: str, size: int, kind: str = "periodic") -> str:
    w = taper(name, size, kind, "t.i")
    total = f"sum({w} * {w})" if what == "density" else f"power(sum({w}), 2)"
    return f"(SELECT {total} FROM range({size}) AS t(i))"


def cut(source: str, keys: str, index: str, length: str, size: int, hop: int, out: str = "win") -> str:
    """Windows of a long-form signal: every sample goes to the windows that hold it."""
    return f"""{out} AS (
  SELECT {keys}, window_idx, {index} - window_idx * {hop} AS i, x FROM (
    SELECT {keys}, {index}, {length} AS len, x,
      unnest(range(greatest(0, ceil(({index} - {size} + 1) / {hop}::DOUBLE))::BIGINT,
                   {index} // {hop} + 1)) AS window_idx
    FROM {source})
  WHERE window_idx <= (len - {size}) // {hop})"""


def dft(source: str, keys: str, nfft: int, weight: str = "1", out: str = "z", bins: int | None = None) -> str:
    bins = bins or nfft // 2 + 1
    angle = f"2 * pi() * ((k * i) % {nfft}) / {nfft}::DOUBLE"
    return f"""{out} AS (
  SELECT {keys}, k, sum(x * {weight} * cos({angle})) AS re, -sum(x * {weight} * sin({angle})) AS im
  FROM {source}, range({bins}) AS b(k) GROUP BY {keys}, k)"""


def psd(keys: str, nfft: int, norm: str, source: str = "z", out: str = "psd") -> str:
    once = "k = 0" + (f" OR k = {nfft // 2}" if nfft % 2 == 0 else "")
    return f"""{out} AS (
  SELECT {keys}, k, (re * re + im * im) * {norm} * CASE WHEN {once} THEN 1 ELSE 2 END AS p
  FROM {source})"""


def density(name: str, size: int, fs: float, kind: str = "periodic") -> str:
    return f"(1 / ({fs}::DOUBLE * {factor('density', name, size, kind)}))"


def bands(nfft: int, fs: float, low: float, high: float, out: str = "bands") -> str:
    """Third-octave bands of a range below fs/2."""
    top = min(fs / 2, 1e6)
    centre = "power(10::DOUBLE, 0.1::DOUBLE * t.i)"
    half = "power(10::DOUBLE, 0.05::DOUBLE)"
    return f"""{out} AS (
  SELECT row_number() OVER (ORDER BY i) - 1 AS band, lo, hi,
    trunc(lo * {nfft} / {fs}::DOUBLE)::BIGINT AS lo_bin,
    trunc(hi * {nfft} / {fs}::DOUBLE)::BIGINT AS hi_bin
  FROM (SELECT i, {centre} / {half} AS lo, {centre} * {half} AS hi FROM range(61) AS t(i))
  WHERE hi >= {low}::DOUBLE AND lo <= {high}::DOUBLE AND hi < {top}::DOUBLE)"""


def db(value: str) -> str:
    """Decibels; silence, at minus infinity, is shown as NULL."""
    return f"CASE WHEN {value} > 0 THEN 10 * log10(greatest({value}, 1e-300::DOUBLE)) END"


def heard(agg: str, value: str = "tol") -> str:
    """An aggregate of levels; silent if one of them is."""
    return f"CASE WHEN count({value}) = count(*) THEN {agg}({value}) END"


R = "l_suppkey, record_idx"
RW = "l_suppkey, record_idx, window_idx"
V = "vec_id"
VW = "vec_id, window_idx"

# Spectra and levels of the records of LIN, scaled by the calibration where asked for.
def lin_psd(size: int, hop: int, nfft: int, source: str = "rec", tag: str = "") -> str:
    win, z, p = "win" + tag, "z" + tag, "psd" + tag
    return ", ".join([
        cut(source, R, "j", "128", size, hop, win),
        dft(win, RW, nfft, taper("hamming", size), z),
        psd(RW, nfft, density("hamming", size, 64), z, p),
    ])


def lin_welch(size: int, hop: int, nfft: int, source: str = "rec") -> str:
    return (
        lin_psd(size, hop, nfft, source)
        + f", welch AS (SELECT {R}, k, avg(p) AS p FROM psd GROUP BY {R}, k)"
    )


def levels(keys: str) -> str:
    """Every band of every key; one without a bin is silent."""
    held = "CASE WHEN k >= lo_bin AND k < hi_bin THEN p ELSE 0 END"
    return f"""tol AS (
  SELECT {keys}, band, {db(f'sum({held})')} AS tol FROM psd_t, bands GROUP BY {keys}, band)"""


def lin_tol(source: str = "rec", low: float = 6.4, high: float = 25.6) -> str:
    return ", ".join([lin_psd(64, 64, 64, source, "_t"), bands(64, 64, low, high), levels(RW)])


WELCH_SPL_ROWS = f"""
  SELECT {R}, 'welch' AS feature, k AS idx, {rnd('p')} AS v FROM welch
  UNION ALL SELECT {R}, 'spl', 0, {rnd(db('sum(p)'))} FROM welch GROUP BY {R}"""
TOL_ROWS = f"""
  UNION ALL SELECT {R}, 'tol', band, {rnd(heard('avg'))} FROM tol GROUP BY {R}, band"""


def frame_files(samples: list[str], per_file: int = 57600) -> str:
    """Decoded samples of the recordings made of LIN, a quarter of an hour per file."""
    channels = " UNION ALL ".join(
        f"SELECT recorder, frame, {c} AS channel, {s} AS v FROM heard" for c, s in enumerate(samples)
    )
    return f"""heard AS (
  SELECT l_suppkey % 4 AS recorder, l_quantity, l_extendedprice,
    row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY {LIN_ORDER}, l_suppkey) - 1 AS frame
  FROM lineitem),
file AS (
  SELECT recorder || '_' || (frame // {per_file}) || '.wav' AS sound_id, frame // {per_file} AS f,
    frame % {per_file} AS j, channel, v,
    count(*) OVER (PARTITION BY recorder, frame // {per_file}, channel) AS n
  FROM ({channels}))"""


def filled(size: int) -> str:
    """The files with their last record filled up with zeros."""
    return f"""ends AS (SELECT DISTINCT sound_id, f, channel, n FROM file),
pad AS (
  SELECT sound_id, f, channel,
    unnest(range(n, ((n + {size - 1}) // {size}) * {size})) AS j, 0::DOUBLE AS v
  FROM ends),
whole AS (
  SELECT sound_id, f, channel, j, v FROM file UNION ALL SELECT sound_id, f, channel, j, v FROM pad)"""


TWO_CHANNELS = [
    "floor(l_extendedprice / 4) / 32768::DOUBLE",
    "floor(l_quantity * 100) / 32768::DOUBLE",
]


def wav(samples: list[str], size: int, where: str, extra: str = "") -> str:
    # A quarter of an hour is 900,000 ms.
    return f"""WITH {frame_files(samples)}
SELECT sound_id, j // {size} AS record_idx, channel,
  f * 900000 + (j // {size}) * {size} * 1000 // 64 AS ms, j % {size} AS i, {rnd('v', 9)} AS v
FROM file WHERE {where}{extra}"""


def wav_fill(
    samples: list[str], size: int, where: str = "true", per_file: int = 57600, dated: bool = True
) -> str:
    start = per_file * 1000 // 64 if dated else 0
    return f"""WITH {frame_files(samples, per_file)}, {filled(size)}
SELECT sound_id, j // {size} AS record_idx, channel,
  f * {start} + (j // {size}) * {size} * 1000 // 64 AS ms,
  j % {size} AS i, {rnd('v', 9)} AS v FROM whole WHERE {where}"""


CHANNEL = "sound_id, record_idx, channel"
CHANNEL_WINDOW = CHANNEL + ", window_idx"


def wav_spectra() -> str:
    """Calibrated spectra and levels of both channels of the recordings."""
    return f"""WITH {frame_files(TWO_CHANNELS)}, {filled(128)},
rec AS (
  SELECT sound_id, j // 128 AS record_idx, channel, j % 128 AS j,
    v / power(10::DOUBLE, -2::DOUBLE / 20) AS x FROM whole),
{cut('rec', CHANNEL, 'j', '128', 32, 16)},
{dft('win', CHANNEL_WINDOW, 32, taper('hamming', 32))},
{psd(CHANNEL_WINDOW, 32, density('hamming', 32, 64))},
welch AS (SELECT {CHANNEL}, k, avg(p) AS p FROM psd GROUP BY {CHANNEL}, k),
{cut('rec', CHANNEL, 'j', '128', 64, 64, 'win_t')},
{dft('win_t', CHANNEL_WINDOW, 64, taper('hamming', 64), 'z_t')},
{psd(CHANNEL_WINDOW, 64, density('hamming', 64, 64), 'z_t', 'psd_t')},
{bands(64, 64, 6.4, 25.6)}, {levels(CHANNEL_WINDOW)}"""


def wav_features() -> str:
    keys = CHANNEL
    return f"""{wav_spectra()}
SELECT {keys}, 'welch' AS feature, k AS idx, {rnd('p')} AS v FROM welch
UNION ALL SELECT {keys}, 'spl', 0, {rnd(db('sum(p)'))} FROM welch GROUP BY {keys}
UNION ALL SELECT {keys}, 'tol', band, {rnd(heard('avg'))} FROM tol GROUP BY {keys}, band"""


def every_feature(start: str, keys: str) -> str:
    windows = keys + ", window_idx"
    return f"""{start}
SELECT 'fft' AS feature, {windows}, 2 * k AS idx, {rnd('re')} AS v FROM z
UNION ALL SELECT 'fft', {windows}, 2 * k + 1, {rnd('im')} FROM z
UNION ALL SELECT 'periodogram', {windows}, k, {rnd('p')} FROM psd
UNION ALL SELECT 'welch', {keys}, -1, k, {rnd('p')} FROM welch
UNION ALL SELECT 'spl', {keys}, -1, 0, {rnd(db('sum(p)'))} FROM welch GROUP BY {keys}
UNION ALL SELECT 'tol', {keys}, -1, band, {rnd(heard('sum'))} FROM tol GROUP BY {keys}, band"""


def damaged() -> str:
    """The audit of the copies of the two-channel recordings."""
    return f"""{frame_files(TWO_CHANNELS)},
sizes AS (SELECT sound_id, count(*) AS n FROM file WHERE channel = 0 GROUP BY sound_id),
kinds(kind, error, known, lost) AS (VALUES
  ('whole', NULL, true, 0),
  ('rifx', 'Input file is big-endian (RIFX), which is not supported', false, 0),
  ('text', 'Input file is not wav', false, 0),
  ('float', 'Input file is not integer-PCM formatted', false, 0),
  ('short', 'Input file length doesn''t match computed one - probably corrupted', true, 1)),
audit AS (
  SELECT kind || '_' || sound_id AS sound_id, error IS NULL AS ok, error,
    CASE WHEN known THEN 64 ELSE 0 END AS fs, CASE WHEN known THEN 2 ELSE 0 END AS channels,
    CASE WHEN known THEN 16 ELSE 0 END AS bits, CASE WHEN known THEN n - lost ELSE 0 END AS frames
  FROM sizes, kinds)"""


def declarations() -> str:
    refused = "doesn''t match configured one"
    return f"""WITH {damaged()},
declared(declared, wrong) AS (VALUES
  ('64.0 2 16', NULL),
  ('48.0 2 16', 'sample rate (64.0) {refused} (48.0)'),
  ('64.0 1 16', 'number of channels (2) {refused} (1)'),
  ('64.0 2 24', 'sample size in bits (16) {refused} (24)'))
SELECT declared, sound_id, coalesce(error || ': ' || sound_id, 'File ' || sound_id || ': ' || wrong) AS error
FROM audit, declared"""


def pcm(bits: int, channels: int) -> str:
    """The bytes of the pages as little-endian signed integers."""
    size, top = bits // 8, 2 ** (bits - 1)
    byte = "('0x' || substr(h, 2 * (s * {size} + {b}) + 1, 2))::BIGINT"
    number = " + ".join(f"{256**b} * {byte.format(size=size, b=b)}" for b in range(size))
    return f"""WITH raw AS (SELECT page_id, hex(encode(html)) AS h FROM pages),
cells AS (
  SELECT page_id, h, unnest(range(length(h) // 2 // {size * channels} * {channels})) AS s FROM raw),
numbers AS (SELECT page_id, s, {number} AS n FROM cells)
SELECT page_id, s % {channels} AS channel, s // {channels} AS i,
  {rnd(f'(n - CASE WHEN n >= {top} THEN {2 * top} ELSE 0 END) / {top}::DOUBLE', 9)} AS v FROM numbers"""


def range_errors() -> str:
    return """WITH ranges AS (
  SELECT o_orderkey, o_custkey % 80 + 50 AS nfft,
    CASE WHEN o_orderkey % 5 > 0 THEN floor(o_totalprice % 40)::DOUBLE END AS low,
    CASE WHEN o_orderkey % 3 > 0 THEN floor(o_totalprice % 37)::DOUBLE END AS high FROM orders),
errors AS (
  SELECT o_orderkey, CASE
    WHEN nfft < 64 THEN 'Incorrect window size (' || nfft || ') for TOL (64.0)'
    WHEN low < 1 OR low > coalesce(high, 32) THEN 'Incorrect low frequency (' || low
      || ') for TOL (smaller than 1.0 or bigger than ' || coalesce(high, 32::DOUBLE) || ')'
    WHEN high < coalesce(low, 1) OR high > 32 THEN 'Incorrect high frequency (' || high
      || ') for TOL (higher than 32.0 or smaller than ' || coalesce(low, 1::DOUBLE) || ')'
  END AS error FROM ranges)
SELECT o_orderkey, error IS NULL AS accepted, error FROM errors"""


def timeserie(tick: int, blocks: int) -> str:
    return f"""WITH span AS (
  SELECT date_trunc('second', min(ts)) AS origin, count(*) AS n FROM events),
ticks AS (SELECT origin, n // {blocks} AS per_block, unnest(range(n)) AS id FROM span),
held AS (
  SELECT date_diff('second', origin, date_trunc('second', ts)) // {tick} AS id,
    count(*) AS n_events, {rnd('sum(value)')} AS total
  FROM events, (SELECT origin FROM span) GROUP BY 1)
SELECT strftime(origin + to_seconds(id * {tick}), '%Y-%m-%d %H:%M:%S') AS ts,
  (id - least(id // per_block, {blocks - 1}) * per_block)::DOUBLE AS val,
  coalesce(n_events, 0) AS n_events, total
FROM ticks LEFT JOIN held USING (id)"""


def tapered(select: str, tail: str = "") -> str:
    parts = []
    for name in COSINES:
        for kind in ("periodic", "symmetric"):
            body = select.format(
                w=taper(name, 64, kind, "j"),
                density=factor("density", name, 64, kind),
                spectrum=factor("spectrum", name, 64, kind),
            )
            parts.append(
                f"SELECT '{name}' AS taper, '{kind}' AS kind, vec_id, {body} FROM emb{tail}"
            )
    return f"WITH {EMB} " + " UNION ALL ".join(parts)


def embedding_dft(nfft: int) -> str:
    return f"""WITH {EMB}, win AS (SELECT vec_id, j AS i, x FROM emb), {dft('win', V, nfft)}"""


def embedding_psd(nfft: int, norm: str) -> str:
    return embedding_dft(nfft) + ", " + psd(V, nfft, norm)


def energy(expression: str) -> str:
    return f"WITH {EMB} SELECT vec_id, {rnd(expression)} AS v FROM emb GROUP BY vec_id"


def records(policy: str) -> str:
    n = "128" if policy == "fill" else "count(*)"
    having = " HAVING count(*) = 128" if policy == "skip" else ""
    return f"""WITH {LIN} SELECT l_suppkey, frame // 128 AS record_idx, {n} AS n,
  {rnd('sum(x)')} AS total, {rnd('min_by(x, frame)')} AS first
FROM lin GROUP BY 1, 2{having}"""


STFT = f"WITH {EMB}, {cut('emb', V, 'j', '64', 32, 16)}, {dft('win', VW, 32, taper('hamming', 32))}"
SIXTY_FOUR = "(1 / 64::DOUBLE)"


def welch_events() -> str:
    keys = "user_id, window_idx"
    return f"""WITH {EVT}, {cut('evt', 'user_id', 'frame', 'n', 32, 16)},
{dft('win', keys, 32, taper('hamming', 32))}, {psd(keys, 32, density('hamming', 32, 32))}
SELECT user_id, k, {rnd('avg(p)')} AS p FROM psd GROUP BY user_id, k"""


def power_spectrum(name: str, kind: str) -> str:
    return f"""WITH {EMB}, win AS (SELECT vec_id, j AS i, x FROM emb),
{dft('win', V, 64, taper(name, 64, kind))},
{psd(V, 64, f"(1 / {factor('spectrum', name, 64, kind)})")}
SELECT vec_id, k, {rnd('p', 9)} AS p FROM psd"""


def tol_records(agg: str, low: float = 6.4, high: float = 25.6) -> str:
    return f"""WITH {REC}, {lin_tol(low=low, high=high)}
SELECT {R}, band, {rnd(heard(agg))} AS tol FROM tol GROUP BY {R}, band"""


def freq(low: float, span: float) -> str:
    return f"({low}::DOUBLE + o_totalprice % {span}::DOUBLE)"


def band_of(expression: str) -> str:
    return f"coalesce((SELECT min(band) FROM bands WHERE {expression} BETWEEN lo AND hi), -1)"


def all_features() -> str:
    start = f"""WITH {REC}, cal AS (
  SELECT {R}, j, x / power(10::DOUBLE, -2::DOUBLE / 20) AS x FROM rec),
{lin_welch(32, 16, 32, 'cal')}, {lin_tol('cal')}"""
    return every_feature(start, R)


def paired_report() -> str:
    margin_a = "CASE WHEN f1 < f2 THEN f2 - f1 END"
    margin_b = "CASE WHEN f1 > f2 THEN f1 - f2 END"
    percentiles = ", ".join(
        f"min(CASE WHEN r{s} = ceil((n - 1) * {p / 100}::DOUBLE) THEN f{s} END) AS f{s}_p{p}"
        for s in (1, 2)
        for p in (25, 50, 75, 90, 95, 99)
    )
    return f"""WITH runs AS (
  SELECT l_returnflag, trunc(l_quantity)::BIGINT AS f1, round(l_tax * 500)::BIGINT AS f2
  FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY f1) - 1 AS r1,
    row_number() OVER (PARTITION BY l_returnflag ORDER BY f2) - 1 AS r2,
    count(*) OVER (PARTITION BY l_returnflag) AS n FROM runs)
SELECT l_returnflag, count(*) AS runs, sum(f1)::BIGINT AS f1_total, sum(f2)::BIGINT AS f2_total,
  (sum(f1) * 100 // (sum(f1) + sum(f2)))::BIGINT AS f1_share,
  (sum(f2) * 100 // (sum(f1) + sum(f2)))::BIGINT AS f2_share,
  {rnd('avg(f1)')} AS f1_mean, {rnd('avg(f2)')} AS f2_mean,
  {rnd('stddev_pop(f1)')} AS f1_stddev, {rnd('stddev_pop(f2)')} AS f2_stddev,
  count({margin_a}) AS f1_wins, count({margin_b}) AS f2_wins,
  count({margin_a}) * 100 // count(*) AS f1_win_share,
  count({margin_b}) * 100 // count(*) AS f2_win_share,
  {rnd(f'avg({margin_a})')} AS f1_win_mean, {rnd(f'avg({margin_b})')} AS f2_win_mean,
  {rnd(f'stddev_pop({margin_a})')} AS f1_win_stddev,
  {rnd(f'stddev_pop({margin_b})')} AS f2_win_stddev,
  {percentiles}
FROM ranked GROUP BY l_returnflag"""


BY_BAND = "l_suppkey, record_idx, window_idx, band"
FRAMES = f"WITH {LIN} SELECT l_suppkey, frame, {rnd('l_extendedprice', 2)} AS v FROM lin"
RMSE = f"WITH {EMB} SELECT {rnd('sqrt(avg(power(x - (x * 1.01::DOUBLE + 0.001::DOUBLE), 2)))', 9)} AS rmse FROM emb"
VECTOR_RMSE = "sqrt(avg(power(x - (x * 1.01::DOUBLE + 0.001::DOUBLE), 2)))"
PER_WINDOW_TOL = (
    f"WITH {REC}, {lin_tol()} SELECT {BY_BAND}, {rnd('tol')} AS tol FROM tol"
)
DEFAULT_TOL = f"WITH {REC}, {lin_tol(low=1, high=32)} SELECT {BY_BAND}, {rnd('tol')} AS tol FROM tol"

_UNTYPED: dict[str, str] = {
    "welch_psd_events": welch_events(),
    "welch_from_windows": welch_events(),
    "welch_in_row": f"""{STFT}, {psd(VW, 32, density('hamming', 32, 64))}
SELECT vec_id, k, {rnd('avg(p)', 9)} AS p FROM psd GROUP BY vec_id, k""",
    "frames_plain": FRAMES,
    "frames_by_bucket": FRAMES,
    "frames_by_range": FRAMES,
    "wav_roundtrip": wav(TWO_CHANNELS, 128, "j < n - n % 128"),
    "wav_records_fill": wav_fill(TWO_CHANNELS, 128),
    "wav_split_files": wav_fill(TWO_CHANNELS, 128),
    "wav_file": wav_fill(TWO_CHANNELS, 128, per_file=86400 * 64),
    "wav_format": wav_fill(TWO_CHANNELS, 128, "j // 128 >= 3", dated=False),
    "wav_format_stream": wav_fill(TWO_CHANNELS, 128, dated=False),
    "wav_records_8bit": wav(
        ["-1 + floor(l_quantity * 4) / 127.5::DOUBLE"], 128, "true"
    ),
    "wav_records_24bit": wav_fill(["floor(l_extendedprice * 64) / 8388608::DOUBLE"], 128),
    "wav_by_path": wav_fill(TWO_CHANNELS, 64),
    "wav_chunks": f"""WITH {frame_files(TWO_CHANNELS)}
SELECT sound_id, (j - 7) // 50 AS record_idx, channel,
  (7 + (j - 7) // 50 * 50) * 1000 // 64 AS ms, (j - 7) % 50 AS i, {rnd('v', 9)} AS v
FROM file WHERE j >= 7 AND j < 157""",
    "wav_inspect": f"""WITH {frame_files(["0"])}
SELECT sound_id, true AS ok, 64 AS fs, 1 AS channels, 24 AS bits, count(*) AS frames
FROM file GROUP BY sound_id""",
    "wav_damaged": f"WITH {damaged()} SELECT * FROM audit",
    "wav_declarations": declarations(),
    "wav_duplicate_names": """SELECT l_suppkey || '_' || year(l_shipdate) || '.wav' AS name, count(*) AS n
FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "wav_features": wav_features(),
    "wav_records_features": wav_features(),
    "decode_pcm": f"""SELECT page_id, 0 AS channel, i, {rnd('-1 + b / 127.5::DOUBLE', 9)} AS v
FROM (
  SELECT page_id, unnest(range(octet_length(url::BLOB))) AS i,
    unnest([ascii(c) for c in string_split(url, '')]) AS b FROM pages)""",
    "decode_pcm_16": pcm(16, 2),
    "decode_pcm_24": pcm(24, 1),
    "decode_pcm_32": pcm(32, 2),
    "timeserie": timeserie(1, 1),
    "timeserie_blocks": timeserie(1, 7),
    "timeserie_tick": timeserie(5, 3),
    "vector_files": f"WITH {EMB} SELECT vec_id, j AS i, {rnd('x')} AS v FROM emb",
    "sound_names": """SELECT
  'S' || l_suppkey || '_64_24_' || count(*) || '_64.0_1_vPSD_32_32_16_64.csv' AS file_name,
  'S' || l_suppkey AS sound_name, 64 AS sys_bits, 24 AS wav_bits, count(*) AS sample_number,
  64::DOUBLE AS sampling_rate, 1 AS channels, 'vPSD' AS algo, 32 AS nfft, 32 AS window_size,
  16 AS window_offset, 64 AS v_sys_bits
FROM lineitem GROUP BY l_suppkey""",
    "grid_to_rows": f"""WITH {EMB}
SELECT vec_id, (j // 8 + 1)::DOUBLE AS lat, (j % 8 - 10)::DOUBLE AS lon, {rnd('x')} AS v FROM emb""",
    "calibrate_signal": f"""SELECT l_suppkey, l_orderkey, l_linenumber,
  {rnd('l_extendedprice / power(10::DOUBLE, -2::DOUBLE / 20)', 4)} AS v FROM lineitem""",
    "calibrate_arrays": f"""WITH {EMB}
SELECT vec_id, j AS i, {rnd('x / power(10::DOUBLE, -20.5::DOUBLE / 20)')} AS v FROM emb""",
    "decibels": f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_tax = 0 AS silent,
  CASE WHEN l_tax > 0 THEN {rnd('10 * log10(CASE WHEN l_tax > 0 THEN l_tax END)')} END AS db
FROM lineitem""",
    "segment_events": f"""WITH {EVT}, {cut('evt', 'user_id', 'frame', 'n', 10, 2)}
SELECT user_id, window_idx, min_by(x, i) AS x_first, max_by(x, i) AS x_last,
  {rnd('sum(x)')} AS x_sum FROM win GROUP BY user_id, window_idx""",
    "segment_counts": """SELECT user_id, 1 + (count(*) - 10) // 2 AS n_windows
FROM events GROUP BY user_id""",
    "segment_tol": f"""WITH {REC}
SELECT {R}, j // 64 AS window_idx, {rnd('sum(x)')} AS x_sum FROM rec GROUP BY 1, 2, 3""",
    "records_skip": records("skip"),
    "records_fill": records("fill"),
    "records_keep": records("keep"),
    "window_coefficients": tapered("j AS i, round(x * {w}, 9) + 0::DOUBLE AS v"),
    "tapered_long": f"WITH {EMB} SELECT vec_id, j AS i, {rnd('x * (j + 1)')} AS v FROM emb",
    "window_norm_factors": tapered(
        "round(sum(power(x * {w}, 2)) / ({density} / power(1.75::DOUBLE, 2)), 6) AS density, "
        "round(power(sum(x * {w}), 2) / ({spectrum} / power(1.75::DOUBLE, 2)), 6) AS spectrum",
        " GROUP BY vec_id",
    ),
    "fft_embeddings": f"{embedding_dft(64)} SELECT vec_id, k, {rnd('re')} AS re, {rnd('im')} AS im FROM z",
    "stft_zero_padded": f"{embedding_dft(128)} SELECT vec_id, k, {rnd('re')} AS re, {rnd('im')} AS im FROM z",
    "stft_odd_nfft": f"{embedding_dft(65)} SELECT vec_id, k, {rnd('re')} AS re, {rnd('im')} AS im FROM z",
    "stft_embeddings": f"{STFT} SELECT {VW}, k, {rnd('re')} AS re, {rnd('im')} AS im FROM z",
    "stft_spectrum_norm": f"""{STFT}, s AS (SELECT sqrt({factor('spectrum', 'hamming', 32)}) AS s)
SELECT {VW}, k, {rnd('re / s', 9)} AS re, {rnd('im / s', 9)} AS im FROM z, s""",
    "fft_two_sided": f"""WITH {EMB}, win AS (SELECT vec_id, j AS i, x FROM emb),
{dft('win', V, 64, bins=64)}
SELECT vec_id, k, {rnd('re')} AS re, {rnd('im')} AS im FROM z""",
    "periodogram_even": f"{embedding_psd(64, SIXTY_FOUR)} SELECT vec_id, k, {rnd('p')} AS p FROM psd",
    "periodogram_odd": f"""{embedding_psd(65, '(1 / 65::DOUBLE)')}
SELECT vec_id, k, {rnd('p')} AS p FROM psd""",
    "power_spectrum_hann": power_spectrum("hann", "periodic"),
    "power_spectrum_blackman": power_spectrum("blackman", "symmetric"),
    "spectrogram_lineitem": f"WITH {REC}, {lin_psd(32, 16, 32)} SELECT {RW}, k, {rnd('p', 9)} AS p FROM psd",
    "freq_to_index": f"""SELECT o_orderkey, trunc({freq(0, 32)} * 64 / 64::DOUBLE)::INT AS idx,
  2 * trunc({freq(0, 32)} * 64 / 64::DOUBLE)::INT AS fft_idx,
  trunc({freq(0, 32)} * 100 / 64::DOUBLE)::INT AS idx_100 FROM orders""",
    "index_to_freq": f"""SELECT o_orderkey, {rnd('(o_custkey % 51) * 44800::DOUBLE / 100')} AS freq,
  {rnd('(o_custkey % 51) // 2 * 44800::DOUBLE / 100')} AS fft_freq FROM orders""",
    "freq_vector": f"""WITH {EMB}, win AS (SELECT vec_id, j AS i, x FROM emb),
{dft('win', V, 65, taper('hamming', 64))}, {psd(V, 65, density('hamming', 64, 64))}
SELECT vec_id, k, {rnd('k * 64::DOUBLE / 65', 9)} AS freq, {rnd('p', 9)} AS p FROM psd""",
    "fft_freq_vector": f"""{embedding_dft(64)}
SELECT vec_id, 2 * k AS j, k::DOUBLE AS freq, {rnd('re')} AS v FROM z
UNION ALL SELECT vec_id, 2 * k + 1, k::DOUBLE, {rnd('im')} FROM z""",
    "energy_raw": energy("sum(x * x)"),
    "energy_fft": energy("sum(x * x)"),
    "energy_psd": energy("sum(x * x)"),
    "spl_raw": energy(db("sum(x * x)")),
    "spl_fft": energy(db("sum(x * x)")),
    "spl_psd": energy(db("sum(x * x)")),
    "tol_bands": f"""WITH {bands(64, 64, 1, 32)},
found AS (SELECT {band_of(freq(1, 31))} AS band FROM orders)
SELECT band, {rnd('lo')} AS lo, {rnd('hi')} AS hi, lo_bin, hi_bin,
  (SELECT count(*) FROM found WHERE found.band = bands.band) AS n FROM bands""",
    "tol_freq_vector": f"""WITH {REC}, {lin_tol()}, mean AS (
  SELECT {R}, band, {heard('avg')} AS tol FROM tol GROUP BY {R}, band),
edges AS (SELECT band, lo, coalesce(lead(lo) OVER (ORDER BY band), hi) AS hi FROM bands)
SELECT {R}, band, {rnd('lo')} AS lo, {rnd('hi')} AS hi, {rnd('tol')} AS tol
FROM mean JOIN edges USING (band)""",
    "freq_to_band": f"WITH {bands(64, 64, 1, 32)} SELECT o_orderkey, {band_of(freq(1, 31))} AS band FROM orders",
    "band_to_freq": f"""WITH {bands(64, 64, 1, 32)},
found AS (SELECT o_orderkey, {band_of(freq(1, 31))} AS band FROM orders)
SELECT o_orderkey, band, {rnd('lo')} AS lo FROM found LEFT JOIN bands USING (band)""",
    "tol_parameters": range_errors(),
    "tol_per_window": PER_WINDOW_TOL,
    "tol_per_window_array": PER_WINDOW_TOL,
    "tol_per_window_default": DEFAULT_TOL,
    "tol_per_window_array_default": DEFAULT_TOL,
    "record_tol_default": tol_records("avg", 1, 32),
    "record_tol": tol_records("avg"),
    "record_tol_sum": tol_records("sum"),
    "tol_workflow": tol_records("avg"),
    "tol_workflow_sorted": tol_records("avg"),
    "tol_sum": tol_records("sum"),
    "welch_spl_workflow": f"WITH {REC}, {lin_welch(32, 16, 32)}{WELCH_SPL_ROWS}",
    "welch_spl_padded": f"WITH {REC}, {lin_welch(24, 12, 29)}{WELCH_SPL_ROWS}",
    "welch_spl_stream": f"WITH {REC}, {lin_welch(32, 16, 32)}{WELCH_SPL_ROWS}",
    "welch_spl_tol_workflow": f"WITH {REC}, {lin_welch(32, 16, 32)}, {lin_tol()}{WELCH_SPL_ROWS}{TOL_ROWS}",
    "shape_features": f"""WITH {REC}, {lin_welch(32, 16, 32)}, spl AS (
  SELECT {R}, sum(p) AS e FROM welch GROUP BY {R})
SELECT {R}, record_idx * 2000 AS ms, c AS channel, {rnd('10 * log10(e * (c + 1) * (c + 1))')} AS spl
FROM spl, range(2) AS t(c)""",
    "all_features": all_features(),
    "all_features_wav": every_feature(wav_spectra(), CHANNEL),
    "rmse_scalar": f"""SELECT l_orderkey, l_linenumber, l_suppkey,
  {rnd('sqrt(power(l_discount - l_tax, 2) / 2)')} AS rmse FROM lineitem""",
    "rmse_vectors": f"WITH {EMB} SELECT vec_id, {rnd(VECTOR_RMSE, 9)} AS rmse FROM emb GROUP BY vec_id",
    "rmse_match": f"""WITH {EMB}
SELECT vec_id, {VECTOR_RMSE} < 0.0103::DOUBLE AS matched FROM emb GROUP BY vec_id""",
    "rmse_tables": RMSE,
    "rmse_segmented": RMSE,
    "rmse_long": RMSE,
    "paired_run_report": paired_report(),
}


# Positions are INTEGER in Spark and BIGINT in SQL: columns to narrow, by query.
INTEGERS = {
    "k": """welch_psd_events welch_from_windows welch_in_row fft_embeddings stft_zero_padded
        stft_odd_nfft stft_embeddings stft_spectrum_norm fft_two_sided periodogram_even
        periodogram_odd power_spectrum_hann power_spectrum_blackman spectrogram_lineitem
        freq_vector""",
    "i": """wav_split_files wav_file wav_format wav_format_stream decode_pcm_16 decode_pcm_24 decode_pcm_32 wav_roundtrip wav_records_fill wav_records_8bit wav_records_24bit wav_by_path
        wav_chunks decode_pcm vector_files calibrate_arrays window_coefficients tapered_long""",
    "j": "fft_freq_vector",
    "n": "records_skip records_keep",
    "idx": """wav_features wav_records_features welch_spl_workflow welch_spl_padded welch_spl_stream
        welch_spl_tol_workflow all_features all_features_wav""",
    "window_idx": """segment_tol stft_embeddings stft_spectrum_norm spectrogram_lineitem
        tol_per_window tol_per_window_array tol_per_window_default tol_per_window_array_default
        all_features all_features_wav""",
    "band": """tol_bands tol_freq_vector freq_to_band band_to_freq tol_per_window
        tol_per_window_array tol_per_window_default tol_per_window_array_default record_tol_default
        record_tol record_tol_sum tol_workflow tol_workflow_sorted tol_sum""",
    "lo_bin": "tol_bands",
    "hi_bin": "tol_bands",
    "channel": "shape_features decode_pcm_16 decode_pcm_24 decode_pcm_32 all_features_wav",
}


def _typed(name: str, sql: str) -> str:
    narrow = ", ".join(f"{c}::INTEGER AS {c}" for c, names in INTEGERS.items() if name in names.split())
    return f"SELECT * REPLACE ({narrow}) FROM ({sql})" if narrow else sql


ORACLES = {name: _typed(name, sql) for name, sql in _UNTYPED.items()}
