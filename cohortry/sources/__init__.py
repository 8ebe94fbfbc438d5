from cohortry.sources.cdm import Cdm
from cohortry.sources.codesets import codes_where, inline_codes, load_codeset, unreadable_cells
from cohortry.sources.results import ResultStore, TableStore, Workspace

__all__ = [
    "Cdm",
    "ResultStore",
    "TableStore",
    "Workspace",
    "codes_where",
    "inline_codes",
    "load_codeset",
    "unreadable_cells",
]
