"""Validated settings of counting, merging and the whole pipeline."""

from __future__ import annotations

import math
from dataclasses import dataclass

DEFAULT_K = 51
COUNT_MODULUS = 1 << 16


def parse_flag(value: str | bool) -> bool:
    """`y` or `n` (or a bool); anything else raises."""
    if isinstance(value, bool):
        return value
    if value in ("y", "n"):
        return value == "y"
    raise ValueError(f"expected 'y' or 'n', got {value!r}")


def parse_index(value: str | int) -> int:
    """A bin index made of decimal digits only."""
    if not str(value).isdigit():
        raise ValueError(f"bin index must be digits only, got {value!r}")
    return int(value)


@dataclass(frozen=True)
class CountConfig:
    """Settings of the counting stage.

    uint16_compat wraps totals modulo 65536 before the singleton filter; without it the
    filter is `count >= 2` on true totals.
    """

    k: int = DEFAULT_K
    num_bins: int = 1500
    uint16_compat: bool = True
    min_filter: bool = True
    keep_poly_a: bool = False

    def __post_init__(self):
        if self.k < 1 or self.k % 2 == 0:
            raise ValueError("k must be odd and positive, so that no k-mer is its own reverse complement")
        if self.num_bins < 1:
            raise ValueError("num_bins must be positive")


@dataclass(frozen=True)
class MatrixConfig:
    """Settings of the merge stage; `bins` is only a label of the output directory."""

    threshold: int = 0
    delimiter: str = "tab"
    count: str | bool = "n"
    core: str | bool = "n"
    bins: int = 0
    index: int | None = None
    row_format: str = "standard"
    on_missing: str = "fail"

    def __post_init__(self):
        if self.delimiter not in ("tab", "none"):
            raise ValueError("delimiter must be 'tab' or 'none'")
        if self.row_format not in ("standard", "single_tab"):
            raise ValueError("row_format must be 'standard' or 'single_tab'")
        if self.on_missing not in ("fail", "zero"):
            raise ValueError("on_missing must be 'fail' or 'zero'")
        if self.threshold < 0 or self.bins < 0:
            raise ValueError("threshold and bins must not be negative")
        object.__setattr__(self, "count", parse_flag(self.count))
        object.__setattr__(self, "core", parse_flag(self.core))
        if self.index is not None:
            object.__setattr__(self, "index", parse_index(self.index))

    @property
    def separator(self) -> str:
        return "\t" if self.delimiter == "tab" else ""

    def directory(self, accessions: int) -> str:
        kind = "count" if self.count else "pres-abs"
        return f"matrix_acc{accessions}_bins{self.bins}_minOcc{self.threshold}_{kind}_delim-{self.delimiter}"


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a full run needs: where reads lie, which accessions, both stages' settings."""

    reads_dir: str
    accessions_file: str
    output_dir: str
    counting: CountConfig = CountConfig()
    matrix: MatrixConfig = MatrixConfig()


def estimate_bins(genome_size, depth, accessions: int, ram_gb, bytes_per_kmer: int = 8) -> dict | None:
    """Memory estimate without binning and the number of bins that fits `ram_gb`; None if an input is unset.

    On Spark the figure is a guide for spark.sql.shuffle.partitions.
    """
    if not genome_size or not depth or not ram_gb:
        return None
    need = int(genome_size) * int(depth) * accessions * bytes_per_kmer / 1024**3
    return {"ram_gb": need, "bins": math.ceil(need / float(ram_gb))}


def bytes_to_human(n: int) -> str:
    """`1536` -> `1.5K`; below 1024 plain bytes."""
    for power, unit in reversed(list(enumerate("KMGTPEZY", start=1))):
        if n >= 1024**power:
            return f"{n / 1024**power:.1f}{unit}"
    return f"{n}B"
