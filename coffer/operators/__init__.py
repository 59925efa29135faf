"""Operators: tables and an ``as_of`` date in, a lazy DataFrame out."""
