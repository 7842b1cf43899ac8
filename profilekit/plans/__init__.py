"""The registered query catalogue (``catalog.QUERIES``) and its DuckDB SQL (``oracle.SQL``)."""
