"""Result and manifest sinks."""

from callstats.sinks.manifest import (
    MANIFEST_DIR,
    check_manifests,
    check_parts,
    leftovers,
    manifest_record,
    read_manifests,
    write_manifest,
)
from callstats.sinks.publish import current, retire, sweep
from callstats.sinks.rejects import read_rejects, write_rejects
from callstats.sinks.results import count_records, write_parts, write_result

__all__ = [
    "MANIFEST_DIR",
    "check_manifests",
    "check_parts",
    "count_records",
    "current",
    "leftovers",
    "manifest_record",
    "read_manifests",
    "read_rejects",
    "retire",
    "sweep",
    "write_manifest",
    "write_parts",
    "write_rejects",
    "write_result",
]
