"""Fixed schemas of the landing files and of the stored tables."""

from __future__ import annotations

# Fields that arrive as a number or as text ("6|168") are read as text.
LIST_RECORD = (
    "dokid BIGINT, nreg STRING, nazva STRING, status INT, typ INT, types STRING, "
    "orgid STRING, org STRING, orgdat BIGINT, poddat BIGINT, pridat BIGINT, n_vlas STRING, "
    "organs STRING, minjust STRING, npix INT, num INT, orgnum STRING"
)
_LIST_PAIRS = [part.split() for part in LIST_RECORD.split(", ")]
LIST_RECORD_FIELDS = [name for name, _ in _LIST_PAIRS]
#: Every field as it came: one mistyped value must not cost its page, nor its record.
LIST_RECORD_TEXT = ", ".join(f"{name} STRING" for name in LIST_RECORD_FIELDS)
LIST_RECORD_KINDS = dict(_LIST_PAIRS)

# Records stay JSON text until each is parsed by itself.
LIST_PAGE = "max STRING, list ARRAY<STRING>, _corrupt_record STRING"

MANIFEST = (
    "id STRING, type STRING, title STRING, language STRING, path STRING, name STRING, format STRING, "
    "item ARRAY<STRUCT<type: STRING, link: STRING, format: STRING, size: BIGINT>>, structure STRING"
)

DICTIONARIES = (
    "source STRING, dict_type STRING, entry_id INT, entry_name STRING, content_hash STRING, "
    "valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, is_current BOOLEAN, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

DOCUMENTS = (
    "version_id STRING, source STRING, source_id STRING, source_reg STRING, title STRING, status_id INT, "
    "org_id INT, doc_date DATE, revision_date DATE, raw_path_revision STRING, raw_path_collection STRING, "
    "processed_path_revision STRING, processed_path_collection STRING, has_text BOOLEAN, text_length INT, "
    "word_count INT, collected_at TIMESTAMP_NTZ, transformed_at TIMESTAMP_NTZ, content_hash STRING, "
    "valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, is_current BOOLEAN, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

DOCUMENT_TYPES = (
    "version_id STRING, type_id INT, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, "
    "is_current BOOLEAN, created_at TIMESTAMP_NTZ"
)

RUNS = (
    "run_id STRING, source STRING, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, status STRING, "
    "documents_found BIGINT, documents_new BIGINT, documents_updated BIGINT, documents_unchanged BIGINT, "
    "documents_failed BIGINT, documents_with_text BIGINT, total_text_length BIGINT, total_word_count BIGINT, "
    "error_message STRING"
)

SNAPSHOTS = (
    "source STRING, snapshot_date DATE, snapshot_path STRING, dict_types ARRAY<STRING>, entry_count INT"
)
