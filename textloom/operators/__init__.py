"""Table-to-table operators: normalise, embed, reduce, neighbours, layouts, explore."""
