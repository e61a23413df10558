"""Text files of vectors and the parameters their names carry."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The parts of a sound's file name, then those of a result computed from it.
SOUND_FIELDS = (
    ("sound_name", "string"),
    ("sys_bits", "int"),
    ("wav_bits", "int"),
    ("sample_number", "bigint"),
    ("sampling_rate", "double"),
    ("channels", "int"),
)
RESULT_FIELDS = (
    ("algo", "string"),
    ("nfft", "int"),
    ("window_size", "int"),
    ("window_offset", "int"),
    ("v_sys_bits", "int"),
)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(file_name, values)``, one row per line of space-separated numbers.

    Complex numbers take two consecutive values.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.trim("value").alias("line")
    )
    numbers = F.transform(F.split("line", " +"), lambda x: x.cast("double"))
    return lines.filter(F.length("line") > 0).select("file_name", numbers.alias("values"))


def _parsed(name: Column, fields) -> Column:
    parts = F.split(F.regexp_replace(name, r"\.(wav|csv|txt)$", ""), "_")
    return F.struct(
        *[F.get(parts, F.lit(i)).cast(dtype).alias(f) for i, (f, dtype) in enumerate(fields)]
    )


def parse_sound_name(name: Column) -> Column:
    """Parameters of a recording, from its file name, as a struct."""
    return _parsed(name, SOUND_FIELDS)


def parse_result_name(name: Column) -> Column:
    """Parameters of a result and of its recording, from its file name, as a struct."""
    return _parsed(name, SOUND_FIELDS + RESULT_FIELDS)


def sound_name(
    name: Column, sys_bits: Column, wav_bits: Column, samples: Column, fs: Column, channels: Column
) -> Column:
    """The parameter part of a recording's file name."""
    rate = fs.cast("double").cast("string")
    parts = [name, sys_bits, wav_bits, samples, rate, channels]
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def result_name(
    sound: Column, algo: Column, nfft: Column, size: Column, offset: Column, v_sys_bits: Column
) -> Column:
    """File name of a result computed from the recording ``sound``."""
    parts = [sound, algo, nfft, size, offset, v_sys_bits]
    return F.concat(F.concat_ws("_", *[p.cast("string") for p in parts]), F.lit(".csv"))
