"""Schemas of the stored records. Keys are checked where rows are written, not by constraints."""

from __future__ import annotations

_META = "title string, publication_date string, source_institution string, clinical_department string"
DOCUMENTS = f"doc_id string, {_META}, publication_year int, document_kind string, abstract string, source_file string, markdown_clean_path string, content_md string, created_at timestamp, updated_at timestamp"
CARDS = f"doc_id string, {_META}, publication_year int, markdown_clean_path string, cleaning_quality string, cleaning_flags string, source_pdf_needs_ocr boolean, pdf_needs_ocr boolean, pdf_is_scanned boolean, pdf_text_quality string, ocr_applied boolean, ocr_status string, card_text string, fields map<string,string>"
VIEWS = f"view_id string, doc_id string, view_type string, priority double, {_META}, markdown_clean_path string, text string"
SECTIONS = f"section_id bigint, doc_id string, section_index int, {_META}, section_path array<string>, heading string, heading_level int, char_start int, char_end int, is_reference_section boolean, content string"
CHUNKS = f"chunk_id string, doc_id string, {_META}, document_kind string, section_path array<string>, chunk_index int, content string, chunk_type string, token_count int, retrieval_key string, retrieval_text string, is_background boolean, is_reference_section boolean, metadata map<string,string>"
EMBEDDINGS = "id string, model string, dim int, embedding array<float>, created_at timestamp"
ALL = {"documents": DOCUMENTS, "document_cards": CARDS, "document_views": VIEWS, "sections": SECTIONS, "chunks": CHUNKS}
