"""Readers and writers: JSON, JSONL, CSV, HTML pages, sitemaps, bundles, and a pluggable crawl source."""
