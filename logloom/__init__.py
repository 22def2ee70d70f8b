"""Log analytics on Apache Spark: parse, mine templates, count, label, profile, classify."""

from logloom.functions.formats import BLOCK_LOG, VM_LOG, LogFormat, Mask, MiningConfig

__all__ = ["BLOCK_LOG", "VM_LOG", "LogFormat", "Mask", "MiningConfig"]
