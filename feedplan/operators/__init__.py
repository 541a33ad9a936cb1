"""DataFrame operators of the synchronisation flow."""
