"""Training-data operators: each module holds one operator, its registered query and (where SQL can
express it) its DuckDB oracle. Nothing else in the library imports this subpackage."""
