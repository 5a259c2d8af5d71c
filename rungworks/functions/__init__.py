"""Column expressions: file-name metadata and small scalar rules."""
