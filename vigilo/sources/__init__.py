"""Raw delimited-file ingestion: contracts, file selection, CSV reading, loads."""

from vigilo.sources.contracts import CONTRACTS, Contract, contract
from vigilo.sources.csv import enforce_contract, header_signatures, read_delimited, read_records, with_provenance
from vigilo.sources.files import list_files, select_exact, select_keyword

__all__ = [
    "CONTRACTS",
    "Contract",
    "contract",
    "enforce_contract",
    "header_signatures",
    "list_files",
    "read_delimited",
    "read_records",
    "select_exact",
    "select_keyword",
    "with_provenance",
]
