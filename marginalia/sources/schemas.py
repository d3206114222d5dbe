"""Explicit, all-nullable record schemas (never inferred).

A sampled inference drops fields that are absent from the sample (e.g.
``extensions.inlineProperties``), so every reader passes one of these.
``position`` / ``ordinal`` make JSON array order explicit.
"""

from __future__ import annotations

from pyspark.sql import types as T

PAGE_DDL = """
id STRING, type STRING, status STRING, title STRING,
space STRUCT<key: STRING>, version STRUCT<number: BIGINT>,
body STRUCT<storage: STRUCT<value: STRING>>,
ancestors ARRAY<STRUCT<id: STRING>>,
_links STRUCT<base: STRING, webui: STRING>
"""

CHILD_DDL = "parent_id STRING, ordinal BIGINT, " + PAGE_DDL

COMMENT_DDL = """
page_id STRING, position BIGINT, id STRING,
history STRUCT<createdDate: STRING, createdBy: STRUCT<displayName: STRING>>,
body STRUCT<storage: STRUCT<value: STRING>>,
extensions STRUCT<inlineProperties: STRUCT<originalSelection: STRING, markerRef: STRING>,
                  resolution: STRUCT<status: STRING>>,
_links STRUCT<webui: STRING>
"""

BATCH_DDL = "entity_id STRING, start BIGINT, results ARRAY<STRUCT<id: STRING, title: STRING>>"

ATTACHMENT_DDL = """
page_id STRING, ordinal BIGINT, id STRING, title STRING,
metadata STRUCT<mediaType: STRING>, extensions STRUCT<fileSize: BIGINT>,
_links STRUCT<base: STRING, download: STRING>
"""

ISSUE_COMMENT_DDL = ("STRUCT<id: STRING, author: STRUCT<displayName: STRING>, "
                     "created: STRING, updated: STRING, body: STRING>")

ISSUE_DDL = f"""
id STRING, key STRING,
fields STRUCT<summary: STRING, status: STRUCT<name: STRING>, issuetype: STRUCT<name: STRING>,
  project: STRUCT<key: STRING>, assignee: STRUCT<displayName: STRING>,
  reporter: STRUCT<displayName: STRING>, updated: STRING,
  comment: STRUCT<total: BIGINT, comments: ARRAY<{ISSUE_COMMENT_DDL}>>>
"""

CREATEMETA_DDL = """
projects ARRAY<STRUCT<key: STRING, name: STRING,
  issuetypes: ARRAY<STRUCT<id: STRING, name: STRING, subtask: BOOLEAN>>>>
"""

EXPORTED_DOC_DDL = "path STRING, text STRING"
MARKDOWN_DOC_DDL = "doc_id STRING, text STRING"
SECTION_EDIT_DDL = "seq BIGINT, page_id STRING, heading STRING, replacement_html STRING"

CHANGE_DDL = """
request_id STRING, seq BIGINT, action STRING, allow_write BOOLEAN, dry_run BOOLEAN,
page_id STRING, space_key STRING, parent_id STRING, new_parent_id STRING, title STRING,
body_html STRING, body_markdown STRING, append_html STRING, append_markdown STRING,
issue_key STRING, project_key STRING, issue_type_name STRING, summary STRING, description STRING,
fields MAP<STRING, STRING>, comment_body STRING, file_name STRING, file_size BIGINT,
comment STRING, major_edit BOOLEAN
"""

ALLOWLIST_DDL = "kind STRING, value STRING"
ERROR_DDL = ("error_id STRING, product STRING, error_type STRING, status_code INT, "
             "message STRING, payload STRING")
MANIFEST_DDL = ("page_id STRING, title STRING, output_file STRING, source_url STRING, "
                "parent_page_id STRING")


def struct_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))
