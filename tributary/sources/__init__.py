"""Readers and writers: raw zone, processed zone, quarantine, warehouse table, watermarks."""
