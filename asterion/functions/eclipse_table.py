"""Lunar eclipses 1990-2027 from the published EclipseWise catalogue.

One line per eclipse: type (T total, P partial, N penumbral), then the UTC
instants P1, U1, U2, greatest, U3, U4, P4; a contact that does not occur is empty.
"""

LUNAR_ECLIPSES = """
T,1990-02-09 16:21,1990-02-09 17:29,1990-02-09 18:50,1990-02-09 19:11,1990-02-09 19:32,1990-02-09 20:53,1990-02-09 22:01
P,1990-08-06 11:31,1990-08-06 12:45,,1990-08-06 14:12,,1990-08-06 15:40,1990-08-06 16:53
N,1991-01-30 04:00,,,1991-01-30 05:59,,,1991-01-30 07:57
N,1991-06-27 01:50,,,1991-06-27 03:15,,,1991-06-27 04:40
N,1991-07-26 16:52,,,1991-07-26 18:08,,,1991-07-26 19:24
P,1991-12-21 08:27,1991-12-21 10:01,,1991-12-21 10:33,,1991-12-21 11:05,1991-12-21 12:39
P,1992-06-15 02:11,1992-06-15 03:27,,1992-06-15 04:57,,1992-06-15 06:27,1992-06-15 07:43
T,1992-12-09 20:57,1992-12-09 22:00,1992-12-09 23:07,1992-12-09 23:44,1992-12-10 00:21,1992-12-10 01:29,1992-12-10 02:31
T,1993-06-04 10:12,1993-06-04 11:11,1993-06-04 12:13,1993-06-04 13:00,1993-06-04 13:48,1993-06-04 14:49,1993-06-04 15:49
T,1993-11-29 03:29,1993-11-29 04:41,1993-11-29 06:03,1993-11-29 06:26,1993-11-29 06:49,1993-11-29 08:12,1993-11-29 09:23
P,1994-05-25 01:20,1994-05-25 02:38,,1994-05-25 03:30,,1994-05-25 04:23,1994-05-25 05:41
N,1994-11-18 04:28,,,1994-11-18 06:44,,,1994-11-18 09:00
P,1995-04-15 10:10,1995-04-15 11:42,,1995-04-15 12:18,,1995-04-15 12:55,1995-04-15 14:26
N,1995-10-08 14:00,,,1995-10-08 16:04,,,1995-10-08 18:08
T,1996-04-04 21:17,1996-04-04 22:21,1996-04-04 23:27,1996-04-05 00:10,1996-04-05 00:53,1996-04-05 01:58,1996-04-05 03:02
T,1996-09-27 00:14,1996-09-27 01:13,1996-09-27 02:20,1996-09-27 02:54,1996-09-27 03:29,1996-09-27 04:36,1996-09-27 05:35
P,1997-03-24 01:42,1997-03-24 02:58,,1997-03-24 04:39,,1997-03-24 06:21,1997-03-24 07:36
T,1997-09-16 16:12,1997-09-16 17:08,1997-09-16 18:16,1997-09-16 18:47,1997-09-16 19:17,1997-09-16 20:25,1997-09-16 21:21
N,1998-03-13 02:17,,,1998-03-13 04:20,,,1998-03-13 06:23
N,1998-08-08 01:37,,,1998-08-08 02:25,,,1998-08-08 03:13
N,1998-09-06 09:16,,,1998-09-06 11:10,,,1998-09-06 13:04
N,1999-01-31 14:07,,,1999-01-31 16:18,,,1999-01-31 18:28
P,1999-07-28 08:58,1999-07-28 10:23,,1999-07-28 11:34,,1999-07-28 12:45,1999-07-28 14:09
T,2000-01-21 02:04,2000-01-21 03:02,2000-01-21 04:05,2000-01-21 04:44,2000-01-21 05:22,2000-01-21 06:25,2000-01-21 07:23
T,2000-07-16 10:48,2000-07-16 11:58,2000-07-16 13:02,2000-07-16 13:56,2000-07-16 14:49,2000-07-16 15:54,2000-07-16 17:03
T,2001-01-09 17:45,2001-01-09 18:42,2001-01-09 19:50,2001-01-09 20:21,2001-01-09 20:51,2001-01-09 21:59,2001-01-09 22:57
P,2001-07-05 12:12,2001-07-05 13:35,,2001-07-05 14:55,,2001-07-05 16:15,2001-07-05 17:38
N,2001-12-30 08:27,,,2001-12-30 10:29,,,2001-12-30 12:31
N,2002-05-26 10:15,,,2002-05-26 12:03,,,2002-05-26 13:52
N,2002-06-24 20:22,,,2002-06-24 21:27,,,2002-06-24 22:32
N,2002-11-20 23:34,,,2002-11-21 01:47,,,2002-11-21 03:59
T,2003-05-16 01:07,2003-05-16 02:03,2003-05-16 03:14,2003-05-16 03:40,2003-05-16 04:06,2003-05-16 05:18,2003-05-16 06:14
T,2003-11-09 22:17,2003-11-09 23:33,2003-11-10 01:07,2003-11-10 01:19,2003-11-10 01:30,2003-11-10 03:05,2003-11-10 04:21
T,2004-05-04 17:52,2004-05-04 18:48,2004-05-04 19:52,2004-05-04 20:30,2004-05-04 21:08,2004-05-04 22:12,2004-05-04 23:08
T,2004-10-28 00:07,2004-10-28 01:14,2004-10-28 02:23,2004-10-28 03:04,2004-10-28 03:44,2004-10-28 04:54,2004-10-28 06:01
N,2005-04-24 07:52,,,2005-04-24 09:55,,,2005-04-24 11:58
P,2005-10-17 09:53,2005-10-17 11:35,,2005-10-17 12:03,,2005-10-17 12:31,2005-10-17 14:13
N,2006-03-14 21:24,,,2006-03-14 23:48,,,2006-03-15 02:12
P,2006-09-07 16:44,2006-09-07 18:06,,2006-09-07 18:51,,2006-09-07 19:37,2006-09-07 20:59
T,2007-03-03 20:18,2007-03-03 21:30,2007-03-03 22:44,2007-03-03 23:21,2007-03-03 23:58,2007-03-04 01:12,2007-03-04 02:24
T,2007-08-28 07:53,2007-08-28 08:51,2007-08-28 09:52,2007-08-28 10:37,2007-08-28 11:23,2007-08-28 12:24,2007-08-28 13:21
T,2008-02-21 00:36,2008-02-21 01:43,2008-02-21 03:01,2008-02-21 03:26,2008-02-21 03:51,2008-02-21 05:09,2008-02-21 06:16
P,2008-08-16 18:24,2008-08-16 19:36,,2008-08-16 21:10,,2008-08-16 22:44,2008-08-16 23:56
N,2009-02-09 12:38,,,2009-02-09 14:38,,,2009-02-09 16:38
N,2009-07-07 08:38,,,2009-07-07 09:39,,,2009-07-07 10:40
N,2009-08-06 23:04,,,2009-08-07 00:39,,,2009-08-07 02:14
P,2009-12-31 17:17,2009-12-31 18:52,,2009-12-31 19:23,,2009-12-31 19:53,2009-12-31 21:29
P,2010-06-26 08:57,2010-06-26 10:17,,2010-06-26 11:38,,2010-06-26 13:00,2010-06-26 14:20
T,2010-12-21 05:29,2010-12-21 06:32,2010-12-21 07:41,2010-12-21 08:17,2010-12-21 08:54,2010-12-21 10:02,2010-12-21 11:05
T,2011-06-15 17:24,2011-06-15 18:23,2011-06-15 19:22,2011-06-15 20:13,2011-06-15 21:03,2011-06-15 22:03,2011-06-15 23:01
T,2011-12-10 11:33,2011-12-10 12:45,2011-12-10 14:06,2011-12-10 14:32,2011-12-10 14:58,2011-12-10 16:18,2011-12-10 17:30
P,2012-06-04 08:48,2012-06-04 10:00,,2012-06-04 11:03,,2012-06-04 12:07,2012-06-04 13:19
N,2012-11-28 12:15,,,2012-11-28 14:33,,,2012-11-28 16:51
P,2013-04-25 18:03,2013-04-25 19:53,,2013-04-25 20:08,,2013-04-25 20:22,2013-04-25 22:12
N,2013-05-25 03:53,,,2013-05-25 04:10,,,2013-05-25 04:28
N,2013-10-18 21:50,,,2013-10-18 23:50,,,2013-10-19 01:50
T,2014-04-15 04:53,2014-04-15 05:58,2014-04-15 07:06,2014-04-15 07:46,2014-04-15 08:25,2014-04-15 09:33,2014-04-15 10:38
T,2014-10-08 08:15,2014-10-08 09:14,2014-10-08 10:25,2014-10-08 10:55,2014-10-08 11:24,2014-10-08 12:35,2014-10-08 13:34
T,2015-04-04 09:01,2015-04-04 10:16,2015-04-04 11:57,2015-04-04 12:00,2015-04-04 12:04,2015-04-04 13:45,2015-04-04 15:00
T,2015-09-28 00:11,2015-09-28 01:07,2015-09-28 02:11,2015-09-28 02:47,2015-09-28 03:24,2015-09-28 04:27,2015-09-28 05:23
N,2016-03-23 09:39,,,2016-03-23 11:47,,,2016-03-23 13:55
N,2016-09-16 16:55,,,2016-09-16 18:54,,,2016-09-16 20:54
N,2017-02-11 22:34,,,2017-02-12 00:44,,,2017-02-12 02:54
P,2017-08-07 15:50,2017-08-07 17:23,,2017-08-07 18:20,,2017-08-07 19:18,2017-08-07 20:51
T,2018-01-31 10:51,2018-01-31 11:48,2018-01-31 12:51,2018-01-31 13:30,2018-01-31 14:08,2018-01-31 15:12,2018-01-31 16:09
T,2018-07-27 17:14,2018-07-27 18:24,2018-07-27 19:30,2018-07-27 20:22,2018-07-27 21:14,2018-07-27 22:19,2018-07-27 23:29
T,2019-01-21 02:36,2019-01-21 03:34,2019-01-21 04:41,2019-01-21 05:12,2019-01-21 05:44,2019-01-21 06:51,2019-01-21 07:48
P,2019-07-16 18:43,2019-07-16 20:01,,2019-07-16 21:31,,2019-07-16 23:00,2019-07-17 00:18
N,2020-01-10 17:07,,,2020-01-10 19:10,,,2020-01-10 21:13
N,2020-06-05 17:46,,,2020-06-05 19:25,,,2020-06-05 21:05
N,2020-07-05 03:07,,,2020-07-05 04:30,,,2020-07-05 05:53
N,2020-11-30 07:32,,,2020-11-30 09:43,,,2020-11-30 11:54
T,2021-05-26 08:47,2021-05-26 09:45,2021-05-26 11:11,2021-05-26 11:19,2021-05-26 11:27,2021-05-26 12:53,2021-05-26 13:50
P,2021-11-19 06:02,2021-11-19 07:18,,2021-11-19 09:03,,2021-11-19 10:48,2021-11-19 12:04
T,2022-05-16 01:32,2022-05-16 02:28,2022-05-16 03:29,2022-05-16 04:12,2022-05-16 04:54,2022-05-16 05:55,2022-05-16 06:51
T,2022-11-08 08:02,2022-11-08 09:09,2022-11-08 10:16,2022-11-08 10:59,2022-11-08 11:42,2022-11-08 12:49,2022-11-08 13:57
N,2023-05-05 15:14,,,2023-05-05 17:23,,,2023-05-05 19:32
P,2023-10-28 18:01,2023-10-28 19:35,,2023-10-28 20:14,,2023-10-28 20:53,2023-10-28 22:27
N,2024-03-25 04:53,,,2024-03-25 07:13,,,2024-03-25 09:33
P,2024-09-18 00:41,2024-09-18 02:13,,2024-09-18 02:44,,2024-09-18 03:16,2024-09-18 04:48
T,2025-03-14 03:57,2025-03-14 05:09,2025-03-14 06:26,2025-03-14 06:59,2025-03-14 07:32,2025-03-14 08:48,2025-03-14 10:01
T,2025-09-07 15:28,2025-09-07 16:27,2025-09-07 17:31,2025-09-07 18:12,2025-09-07 18:53,2025-09-07 19:57,2025-09-07 20:55
T,2026-03-03 08:44,2026-03-03 09:50,2026-03-03 11:04,2026-03-03 11:34,2026-03-03 12:03,2026-03-03 13:17,2026-03-03 14:23
P,2026-08-28 01:23,2026-08-28 02:33,,2026-08-28 04:13,,2026-08-28 05:52,2026-08-28 07:02
N,2027-02-20 21:12,,,2027-02-20 23:13,,,2027-02-21 01:13
N,2027-07-18 15:54,,,2027-07-18 16:03,,,2027-07-18 16:12
N,2027-08-17 05:24,,,2027-08-17 07:14,,,2027-08-17 09:03
"""
