"""Named query plans (``queries``) and their DuckDB SQL oracles (``oracles``)."""
