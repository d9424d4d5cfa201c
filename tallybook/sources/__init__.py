from tallybook.sources.manifests import MANIFEST_SCHEMA, read_manifest, write_bucketed, write_manifest
from tallybook.sources.payloads import scan_payloads
from tallybook.sources.pointers import POINTER_MAX_BYTES, POINTER_VERSION, misfit_files, read_pointer, scan_pointers
from tallybook.sources.tables import documents_manifest, pages_addresses, read_table
from tallybook.sources.tree import scan_tree

__all__ = [
    "MANIFEST_SCHEMA",
    "POINTER_MAX_BYTES",
    "POINTER_VERSION",
    "documents_manifest",
    "misfit_files",
    "pages_addresses",
    "read_manifest",
    "read_pointer",
    "read_table",
    "scan_payloads",
    "scan_pointers",
    "scan_tree",
    "write_bucketed",
    "write_manifest",
]
