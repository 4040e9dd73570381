"""Raw-file readers, layered writers and warehouse-table helpers."""
