"""The registered queries: reference inputs derived from the driver tables
(``derive``), each operator run over them (``queries``), and the matching
DuckDB SQL (``oracle``)."""
