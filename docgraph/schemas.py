"""Relations of the document graph, as DDL. Every column can be null; a key that is absent is null."""

RAW_PAGE = "url STRING, status INT, content_type STRING, body STRING, bytes LONG, fetched_at TIMESTAMP, truncated BOOLEAN"
NODE = "doc STRING, title STRING, parent STRING, depth INT, closed BOOLEAN, url STRING, slug STRING, nav_order INT, src STRING, out_of_scope BOOLEAN, reparented_by_name BOOLEAN, is_space_root BOOLEAN"
NAV_EDGE = "page_doc STRING, doc STRING, parent STRING, title STRING, ord INT"
LINK_EDGE = "src_doc STRING, pos INT, href STRING, abs_url STRING, target_doc STRING, how STRING, kind STRING, text STRING"
PAGE_META = "doc STRING, title STRING, words LONG, text_chars LONG, images LONG, tables LONG, links_internal LONG, links_external LONG, is_redirect BOOLEAN, redirect_to STRING, error STRING, html_bytes LONG, notes ARRAY<STRING>"
ATTACHMENT = "doc STRING, name STRING, url STRING, mirrored BOOLEAN, bytes LONG, sha256 STRING, missing_reason STRING"
RENDER_RESULT = "doc STRING, pages INT, ok BOOLEAN, error STRING, cached BOOLEAN, degraded STRING, profile MAP<STRING,LONG>"
STRUCTURE = "doc STRING, seq INT, first_page INT, last_page INT, pages INT"
ANNOTATION = "pdf_page INT, src_doc STRING, uri STRING, dest_doc STRING, has_action BOOLEAN"
PAGE_MAP = "doc STRING, title STRING, pages INT, page INT, chars LONG, title_found BOOLEAN, source_marker_found BOOLEAN, status STRING, notes ARRAY<STRING>"
