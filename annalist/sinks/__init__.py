"""Writers: partition layouts, history tables, artefacts."""
