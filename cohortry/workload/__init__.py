"""The registered queries: sample tables dressed as the domain tables, and their SQL twins."""
