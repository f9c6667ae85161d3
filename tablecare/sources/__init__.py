"""Reading, writing, copying and profiling tables."""
