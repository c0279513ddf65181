"""Readers: knowledge bases and manifests as JSON, approvals as CSV, DOCX containers, page caches, picture folders."""
