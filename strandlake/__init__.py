"""strandlake: k-mer x accession analytics expressed as Spark DataFrame plans."""

from strandlake.config import CountConfig, MatrixConfig, PipelineConfig

__all__ = ["CountConfig", "MatrixConfig", "PipelineConfig"]
