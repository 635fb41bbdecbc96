"""DataFrame -> DataFrame operators: framing, segmentation, event table, marts."""
