"""Lake layers: what each table is and how it is built."""
