"""Operators for large text-training pipelines (quality, dedup, mixing, packing, ...).

Nothing outside this subpackage imports it; its queries are added to the driver
contract only if it can be imported.
"""
