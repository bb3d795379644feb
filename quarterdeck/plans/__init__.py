"""Input shapes and end-to-end runs built from the operators."""
