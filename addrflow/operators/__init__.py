"""DataFrame -> DataFrame operators of the contact job."""
