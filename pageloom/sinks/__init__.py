"""Writers; each one can be run again without doubling its output."""
