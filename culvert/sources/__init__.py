"""Feeds in, staged tables, dated snapshots, results out."""

from culvert.sources.delimited import normalise_headers, read_delimited
from culvert.sources.publication import Publication, published, read_published
from culvert.sources.records import read_records
from culvert.sources.results import write_result
from culvert.sources.snapshots import as_of, read_snapshot, write_snapshot
from culvert.sources.staging import STAGED, from_folder, stage

__all__ = [
    "Publication",
    "STAGED",
    "as_of",
    "from_folder",
    "normalise_headers",
    "published",
    "read_delimited",
    "read_published",
    "read_records",
    "read_snapshot",
    "stage",
    "write_result",
    "write_snapshot",
]
