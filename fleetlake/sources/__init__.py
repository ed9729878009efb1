"""Readers: message landing files, Bronze/Silver tables, lineage scans."""
