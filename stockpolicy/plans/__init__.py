"""Reports and end-to-end plans composed from the operators."""
