"""Relations of the engine, as Spark DDL."""

SELECTED_SOURCES = "arxiv_id STRING, month STRING, source_tar STRING, source_key STRING, source_member STRING, output_key STRING, size BIGINT, sha256 STRING, reasons ARRAY<STRING>"
LISTING = "key STRING, size BIGINT, month STRING, etag STRING, last_modified TIMESTAMP"
COMPLETION = "month STRING, source_key STRING, source_etag STRING, source_size BIGINT, papers_seen BIGINT, invalid_packages BIGINT, matches BIGINT, started_at STRING, finished_at STRING"
RECOVERY_STATE = "arxiv_id STRING, month STRING, status STRING, reason STRING, paper_path STRING, candidate_count INT, drawio_files INT, duplicate_drawio_removed INT, failed_candidates ARRAY<STRUCT<source_rel: STRING, returncode: INT, timed_out: BOOLEAN, output: STRING>>, error STRING, finished_at STRING"
RENDER_STATUS = "arxiv_id STRING, status STRING, drawio_files INT, png_images INT, figures ARRAY<STRUCT<drawio_path: STRING, image_path: STRING, page_number: INT, page_name: STRING, scale: DOUBLE, width: INT, height: INT, vertices: INT, edges: INT, elements: INT, images: INT, texts: INT>>, errors ARRAY<STRUCT<drawio_path: STRING, page_number: INT, error: STRING>>"
MANIFEST = "arxiv_id STRING, folder STRING, metadata_path STRING, paper_markdown_path STRING, text_status_path STRING"
CATEGORIES = "arxiv_id STRING, categories ARRAY<STRING>, title STRING"
PAGE_METRICS = "page_name STRING, verts INT, edges INT, elements INT, boxes INT, images INT, texts INT"
IMAGE_FEATURES = "png_w INT, png_h INT, phash STRING, dhash STRING, ink_ratio DOUBLE, gray_mean DOUBLE, gray_std DOUBLE, thumbnail BINARY, image_error STRING"
MODEL_SCORES = "png STRING, positive_logit DOUBLE, negative_logit DOUBLE, model_margin DOUBLE, model_keep BOOLEAN, model_error STRING"
SHARD_REPORT = "filename STRING, bytes BIGINT, sha256 STRING, papers ARRAY<STRING>"
