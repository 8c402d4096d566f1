"""Operators of a training-data pipeline. Nothing else in strandlake imports this subpackage."""
