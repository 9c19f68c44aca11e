"""Column functions: HTML text helpers and Brazilian money parsing."""
