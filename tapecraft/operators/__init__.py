"""DataFrame -> DataFrame operators over trade tapes and bars."""
