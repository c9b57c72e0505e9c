"""Binds the operators to the benchmark tables, with an SQL oracle for each."""
