"""Order-free random streams: every draw is a hash of its own address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_64 = 18446744073709551616.0


def _as_text(part) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))


def stream_address(*parts) -> Column:
    """``seed:slot:attempt:stream`` as text."""
    return F.concat_ws(":", *[_as_text(part) for part in parts])


def derive_seed(*parts, nbytes: int = 8) -> Column:
    """Unsigned big-endian integer from the first bytes of SHA-256 of the address."""
    digest = F.sha2(stream_address(*parts), 256)
    return F.conv(F.substring(digest, 1, 2 * nbytes), 16, 10).cast("decimal(20,0)")


def hash_uniform(*parts) -> Column:
    """Uniform double in [0, 1) owned by the address."""
    return derive_seed(*parts).cast("double") / F.lit(TWO_POW_64)


def sample_identity(label, run_id, slot) -> Column:
    """Stable sample name: label, zero-padded slot, short hash of run and slot."""
    suffix = F.substring(F.sha2(stream_address(run_id, slot), 256), 1, 8)
    label = label if isinstance(label, Column) else F.lit(label)
    return F.format_string("%s_%06d_%s", label, slot.cast("bigint"), suffix)


def image_file_name(sample_id: Column, image_format) -> Column:
    """File name of a sample; ``jpeg`` is stored under the extension ``jpg``."""
    fmt = image_format if isinstance(image_format, Column) else F.lit(image_format)
    return F.concat(sample_id, F.lit("."), F.when(fmt == "jpeg", "jpg").otherwise(fmt))
