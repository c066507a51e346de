"""Jobs: read, apply the operators, write. One function per scheduled job."""
