"""Report pages and the batch refresh, composed from the operators."""
