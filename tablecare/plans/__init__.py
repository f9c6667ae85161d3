"""Jobs built from several operators: reports, repairs, guarded SQL, and the query catalogue."""
