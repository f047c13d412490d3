"""The layers: what each table is made of, expressed with the operators."""
