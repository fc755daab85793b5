"""Writers: messages, database tables, upserts and the console."""
